"""Operator 7, SentencePiece encoding and decoding by a streaming Viterbi search.

The vocabulary is a given SentencePiece model file (never trained).  A path's score is the sum of
its pieces' log-probabilities; a byte-pair model stores merge ranks instead, from which Zipf's law
gives them: -log(rank + 2).  Characters in no piece become byte pieces.

The search reads a text from left to right and keeps only the last ``max piece length`` + 1
boundaries.  Whenever the back pointers of all kept boundaries meet in one boundary, the ids up to
it are final and leave the window.  A boundary in front of white space is always such a place (no
piece continues from a word into white space), so all that stands between two of them, a word, is
committed with its end at the latest, and equal words have equal ids.  ``Lanes`` is this search over many
distinct words of a slice of texts at once, one lane a word, a step a character; ``Pieces.viterbi`` is
the same search over one text, for words of ``LANE`` characters or more.  Nothing is remembered from one slice
to the next.

Encoding follows SentencePiece: a space is put in front, spaces become U+2581.  A text's own U+2581
is encoded as bytes, so that decode(encode(text)) == text for every text.  Defined cases: null
stays null (ids null); an empty text has no ids; ties go to the longer last piece; repeated rows and
null ids are encoded row by row; other columns come back untouched; an empty table gives an empty
result.  The model file must lie at the same path on every executor.
"""
from __future__ import annotations

import hashlib
import math
import re
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridegrid.llm import common as C

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
#: Scores are whole numbers of this fraction, so that sums are exact and ties are real ties.
UNIT = 1_000_000
#: Words of this many characters or more are searched one by one.
LANE = 96
#: Text in a slice, words searched at a time, and ids turned back into bytes at a time.
SLICE_BYTES, LANES, IDS = 2 << 20, 1 << 15, 1 << 16
#: Rolling hashes of code points: the factor, and the bits of the sieve of piece hashes.
FACTOR, SIEVE = np.uint64(0xD1342543DE82EF95), 20


class Pieces:
    """A vocabulary: piece text to (id, score), byte pieces, and id to the bytes it stands for."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        stored = np.array([sp.get_score(i) for i in range(n)])
        ranked = bool((stored <= 0).all() and float(stored[stored > -1e8].min()) < -100)
        self.byte_ids = [0] * 256
        self.bytes: list[bytes] = [b""] * n
        self.score: dict[str, tuple[int, int]] = {}
        for i in range(n):
            if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                continue
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                value = int(piece[3:-1], 16)
                self.byte_ids[value] = i
                self.bytes[i] = bytes([value])
                continue
            self.bytes[i] = piece.replace(SPACE, " ").encode()
            score = -math.log(max(-stored[i], 0) + 2) if ranked else float(stored[i])
            if stored[i] <= -1e8:  # user-defined runs of spaces have no rank
                score = -math.log(n)
            self.score[piece.replace(SPACE, " ")] = (round(score * UNIT), i)
        self.longest = max(map(len, self.score))
        self.byte_score = round(-2.0 * math.log(n) * UNIT)
        self.ends = np.concatenate(([0], np.cumsum([len(b) for b in self.bytes])))
        self.flat = np.frombuffer(b"".join(self.bytes), np.uint8)
        crossing = [p for p in self.score if re.search(r"[^ ] |\n", p) and len(p) > 1]
        if crossing:
            raise ValueError(f"pieces run from words into white space: {crossing[:3]}")

    def viterbi(self, text: str, committed=None) -> list[int]:
        """Ids of a text in which U+2581 is an ordinary character and a space is a space."""
        out: list[int] = []
        longest, table, low = self.longest, self.score, self.byte_score
        best = {0: 0}  # boundary -> score, for the last `longest` boundaries
        back: dict[int, tuple[int, tuple[int, ...]]] = {}  # boundary -> (boundary before, ids)
        base, look = 0, longest  # all before base is committed; look for a meeting place at look
        for end in range(1, len(text) + 1):
            top, link = -math.inf, None
            for start in range(max(base, end - longest), end):
                got = table.get(text[start:end]) if start in best else None
                if got is not None and best[start] + got[0] > top:
                    top, link = best[start] + got[0], (start, (got[1],))
            char = text[end - 1]
            if char not in table or link is None:
                raw = char.encode()
                score = best[end - 1] + low * len(raw)
                if score > top:
                    top, link = score, (end - 1, tuple(self.byte_ids[b] for b in raw))
            best[end], back[end] = top, link
            best.pop(end - longest - 1, None)
            if end >= look or end == len(text):  # do all surviving paths meet?
                look = end + max(longest, end - base)
                alive = {e for e in best if e > base} if end < len(text) else {end}
                low_at = min(best) if end < len(text) else end
                if low_at > base or end == len(text):
                    meet = set(alive)
                    while len(meet) > 1:
                        far = max(meet)
                        meet.remove(far)
                        meet.add(max(back[far][0], base))
                    at = meet.pop() if meet else base
                    if at > base:
                        path, e = [], at
                        while e > base:
                            path.append(back[e][1])
                            e = back[e][0]
                        out.extend(chain.from_iterable(reversed(path)))
                        for e in range(base + 1, at + 1):
                            back.pop(e, None)
                        base, look = at, end + longest
                        if committed is not None:
                            committed.append(at)
        return out


class Lanes:
    """The streaming search over many words at once."""

    def __init__(self, pieces: Pieces):
        self.pieces, self.window = pieces, pieces.longest + 1
        names = list(pieces.score)
        keys = np.array([self._hash(np.array([ord(c) for c in p])) for p in names], np.uint64)
        by = np.argsort(keys)
        self.keys = keys[by]
        if (self.keys[1:] == self.keys[:-1]).any():
            raise ValueError("two pieces share a hash")
        scores = np.array([pieces.score[p] for p in names], np.int64)[by]
        self.score, self.id = scores[:, 0], scores[:, 1].astype(np.int32)
        self.sieve = np.zeros(1 << SIEVE, bool)
        self.sieve[(self.keys >> np.uint64(64 - SIEVE)).astype(np.int64)] = True
        self.lengths = sorted({len(p) for p in names}, reverse=True)
        # the factor to the power of each length, to take the front off a rolling hash
        power = np.full(self.window, FACTOR, np.uint64)
        power[0] = 1
        self.power = np.cumprod(power, dtype=np.uint64)

    def _hash(self, codes: np.ndarray) -> int:
        h = 0
        for m in C.mix(codes.astype(np.uint64) + C.ODD).tolist():
            h = (h * int(FACTOR) + m) % (1 << 64)
        return int(self._key(np.array([h], np.uint64), len(codes))[0])

    @staticmethod
    def _key(h: np.ndarray, length: int) -> np.ndarray:
        key = (h ^ np.uint64(length * 0x9E3779B97F4A7C15 % (1 << 64))) * np.uint64(0xBF58476D1CE4E5B9)
        return (key ^ (key >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)

    def _pieces(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(lanes whose key is a piece's, the pieces' numbers)."""
        maybe = np.flatnonzero(self.sieve[(key >> np.uint64(64 - SIEVE)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.keys, key[maybe]), len(self.keys) - 1)
        hit = self.keys[at] == key[maybe]
        return maybe[hit], at[hit]

    def search(self, codes: np.ndarray, offsets: np.ndarray, commits: list | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, offset of each word's ids) of words given as code points.

        ``commits``: gets the number of commits, (lanes, before their word's end).
        """
        size = np.diff(offsets)
        lane = np.argsort(-size, kind="stable")  # the lanes that still read are always the first ones
        start, size = offsets[:-1][lane], size[lane]
        longest, w = self.pieces.longest, self.window
        low = self.pieces.byte_score
        best = np.zeros((w, len(lane)), np.int64)  # boundary e lies in row e % w: only the window is kept
        rolled = np.zeros((w, len(lane)), np.uint64)
        base = np.zeros(len(lane), np.int64)  # all before is committed
        back = np.zeros(len(codes), np.int16)  # of each boundary: the length of its last piece
        link = np.full(len(codes), -1, np.int32)  # and its id; -1: the bytes of the character
        final = np.zeros(len(codes), bool)  # boundaries of committed paths
        mixed = C.mix(codes.astype(np.uint64) + C.ODD)
        extra = np.where(codes < 0x80, 1, np.where(codes < 0x800, 2, np.where(codes < 0x10000, 3, 4)))
        early = 0
        steps = int(size[0]) if len(size) else 0
        reading = np.searchsorted(-size, -np.arange(1, steps + 1), side="right")
        for end in range(1, steps + 1):
            n = int(reading[end - 1])
            at = start[:n] + end - 1
            now, h = end % w, rolled[(end - 1) % w, :n] * FACTOR + mixed[at]
            rolled[now, :n] = h
            top, known = np.full(n, np.iinfo(np.int64).min), np.zeros(n, bool)
            for length in self.lengths:  # the longest first: it wins ties
                if length > end:
                    continue
                before = (end - length) % w
                who, piece = self._pieces(self._key(h - rolled[before, :n] * self.power[length], length))
                score = best[before, who] + self.score[piece]
                better = score > top[who]
                who, piece = who[better], piece[better]
                top[who] = score[better]
                link[at[who]], back[at[who]] = self.id[piece], length
                if length == 1:
                    known[who] = True
            plain = np.flatnonzero(~known & (top < (byte := best[(end - 1) % w, :n] + low * extra[at])))
            if len(plain) and 1 in self.lengths:  # the character itself may be a piece that lost
                one, _ = self._pieces(self._key(mixed[at[plain]], 1))
                plain = np.delete(plain, one)
            top[plain] = byte[plain]
            link[at[plain]], back[at[plain]] = -1, 1
            best[now, :n] = top
            if end % longest == 0 and end > longest:
                early += self._meet(np.flatnonzero(size[:n] > end), end, start, base, back, final)
            done = np.flatnonzero(size[:n] == end)
            self._commit(done, np.full(len(done), end), start, base, back, final)
        if commits is not None:
            commits.append((len(lane), early))
        return self._ids(codes, offsets, link, final, extra)

    def _meet(self, lanes, end, start, base, back, final) -> int:
        """Commit the lanes whose surviving paths all meet; returns how many did."""
        if not len(lanes):
            return 0
        alive = end - np.arange(self.window - 1)[None, :] + np.zeros((len(lanes), 1), np.int64)
        alive = np.maximum(alive, base[lanes][:, None])  # nothing survives from before the last commit
        while True:
            far, near = alive.max(axis=1), alive.min(axis=1)
            open_ = np.flatnonzero((far > near) & (near > base[lanes]))
            if not len(open_):
                break
            who = lanes[open_]
            step = far[open_] - back[start[who] + far[open_] - 1]
            some = alive[open_]
            alive[open_] = np.where(some == far[open_][:, None], step[:, None], some)
        met = np.flatnonzero((far == near) & (far > base[lanes]))
        self._commit(lanes[met], far[met], start, base, back, final)
        return len(met)

    @staticmethod
    def _commit(lanes, at, start, base, back, final):
        """Mark the paths from the boundaries ``at`` back to the last commit as final."""
        left, place = lanes, at.copy()
        while len(left):
            on = place > base[left]
            left, place = left[on], place[on]
            final[start[left] + place - 1] = True
            place = place - back[start[left] + place - 1]
        base[lanes] = at

    def _ids(self, codes, offsets, link, final, extra) -> tuple[np.ndarray, np.ndarray]:
        at = np.flatnonzero(final)
        ids = link[at]
        times = np.where(ids < 0, extra[at], 1)
        ends = np.concatenate(([0], np.cumsum(times)))
        word = np.searchsorted(at, offsets)
        out = np.repeat(ids, times)
        raw = np.flatnonzero(ids < 0)
        chars, which = np.unique(codes[at[raw]], return_inverse=True)
        bytes_ = [[self.pieces.byte_ids[b] for b in chr(c).encode()] for c in chars.tolist()]
        for k in range(4):
            has = np.array([len(b) > k for b in bytes_], bool)
            value = np.array([b[k] if len(b) > k else 0 for b in bytes_], np.int32)
            use = has[which] if len(chars) else np.zeros(0, bool)
            out[ends[raw[use]] + k] = value[which[use]] if len(chars) else 0
        return out, ends[word]


SPACE_BYTE, LINE_BYTE = 0x20, 0x0A


def split_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(the number of each word, the distinct words, offset of each text's first word and the end).

    A word is a run of spaces and what follows up to the next space or line end, or a line end; no piece crosses
    these cuts.  Every text but an empty one has a space put in front.
    """
    data, off = C.utf8(texts)
    full = np.diff(off) > 0
    data = np.insert(data, off[:-1][full], SPACE_BYTE)
    off = off + np.concatenate(([0], np.cumsum(full)))
    before = np.empty(len(data), np.uint8)
    before[1:] = data[:-1]
    before[off[:-1][full]] = LINE_BYTE
    cut = (data == LINE_BYTE) | ((data == SPACE_BYTE) & (before != SPACE_BYTE)) | (
        (data != SPACE_BYTE) & (before == LINE_BYTE))
    starts = np.flatnonzero(cut)
    ends = np.append(starts, len(data))
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(
        np.ascontiguousarray(data))]).dictionary_encode()
    return words.indices.to_numpy().astype(np.int64), words.dictionary, np.searchsorted(starts, off)


def gathered(values: np.ndarray, offsets: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lists ``which`` of (values, offsets), one after the other, and their offsets."""
    sizes = np.diff(offsets)[which]
    ends = np.concatenate(([0], np.cumsum(sizes)))
    return values[np.repeat(offsets[:-1][which] - ends[:-1], sizes) + np.arange(ends[-1])], ends


def encode_words(words: pa.Array, lanes: Lanes, commits: list | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all distinct words, offset of each word's ids)."""
    data, off = C.utf8(words)
    begins = np.flatnonzero((data & 0xC0) != 0x80)  # the first byte of each character
    codes = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32).astype(np.int64)
    chars = np.searchsorted(begins, off)
    sizes = np.diff(chars)
    order = np.argsort(sizes, kind="stable")  # words of like length are searched together
    n = int(np.count_nonzero(sizes < LANE))
    parts, counts = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
    for i in range(0, n, LANES):
        which = order[i:min(i + LANES, n)]
        ids, ends = lanes.search(*gathered(codes, chars, which), commits)
        if bytes(_bytes_of(ids, lanes.pieces)) != bytes(gathered(data, off, which)[0]):
            raise ValueError("ids do not decode to their words: a hash of a piece is not unique")
        parts.append(ids)
        counts.append(np.diff(ends))
    for i in order[n:].tolist():  # the long words, one by one
        parts.append(np.array(lanes.pieces.viterbi(bytes(data[off[i]:off[i + 1]]).decode(), commits), np.int32))
        counts.append(np.array([len(parts[-1])]))
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return gathered(np.concatenate(parts), np.concatenate(([0], np.cumsum(np.concatenate(counts)))), place)


def _bytes_of(ids: np.ndarray, pieces: Pieces) -> np.ndarray:
    if len(ids) <= IDS:
        return gathered(pieces.flat, pieces.ends, ids)[0]
    return np.concatenate([gathered(pieces.flat, pieces.ends, ids[i:i + IDS])[0] for i in range(0, len(ids), IDS)])


def encode_texts(texts: pa.Array, lanes: Lanes) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts, offset of each text's ids); a null text has none."""
    number, words, first = split_words(texts)
    ids, ends = encode_words(words, lanes)
    out, word_ends = gathered(ids, ends, number)
    return out, word_ends[first]


@lru_cache(maxsize=2)
def load(path: str) -> Lanes:
    return Lanes(Pieces(path))


def decode_ids(ids, pieces: Pieces) -> str:
    raw = bytes(_bytes_of(np.asarray(ids, np.int64), pieces))
    return raw.decode("utf-8", "replace")[1:] if raw else ""


def _encode(path: str, digest: bool = False):
    """Adds ``ids``; with ``digest`` also the SHA-256 of the text that they decode to."""
    def run(batches):
        lanes = load(path)
        for batch in C.text_slices(batches, "_text", SLICE_BYTES):
            texts = batch.column("_text")
            ids, ends = encode_texts(texts, lanes)
            null = texts.is_null()
            column = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()), mask=null)
            more = []
            if digest:
                raw = _bytes_of(ids, lanes.pieces)
                sizes = np.concatenate(([0], np.cumsum(np.diff(lanes.pieces.ends)[ids])))[ends].tolist()
                raw = raw.tobytes()
                more = [pa.array([None if gone else hashlib.sha256(raw[a + 1:b]).hexdigest() for a, b, gone in zip(
                    sizes[:-1], sizes[1:], null.to_pylist(), strict=True)], pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column("_row"), column, *more],
                                             names=["_row", "ids", "decoded_sha256"][:2 + digest])

    return run


def _decode(path: str):
    def run(batches):
        pieces = load(path).pieces
        for batch in batches:
            ids = batch.column("_text")
            texts = [None if not x.is_valid else decode_ids(x.values.to_numpy().tolist(), pieces) for x in ids]
            yield pa.RecordBatch.from_arrays([batch.column("_row"), pa.array(texts, pa.string())],
                                             names=["_row", "decoded"])

    return run


def encode(docs: DataFrame, text: str = "text", model: str = MODEL, keep=None) -> DataFrame:
    """Every row of ``docs`` (struct ``_row``, of the columns in ``keep``, all by default) with its ``ids``."""
    df, row = C.carried(docs, text, keep)
    return C.map_arrow(df, _encode(model), f"_row {row}, ids array<int>")


def decode(rows: DataFrame, ids: str = "ids", model: str = MODEL) -> DataFrame:
    """Every row of ``rows`` (struct ``_row``) with its text, ``decoded``."""
    df, row = C.carried(rows, ids)
    return C.map_arrow(df, _decode(model), f"_row {row}, decoded string")


def encoded_documents(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """doc_id, ids, their number, and the digest of the text that the ids decode to."""
    df, row = C.carried(docs, "text", ["doc_id"])  # decoded in the same task: ids travel once
    ids = C.map_arrow(df, _encode(model, digest=True), f"_row {row}, ids array<int>, decoded_sha256 string")
    return ids.select("_row.doc_id", "ids", F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_ids"),
                      "decoded_sha256")


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded_documents(C.table(spark, sf_dir, "documents"))
