"""Operator 4, benchmark decontamination with an FM-index per training shard.

Test phrases are the runs of ``window`` consecutive words of each benchmark item (a shorter item is
one phrase).  A shard is a slice of documents in one task.  Its words are numbered; the number
sequence, read backwards from its suffix array, is the Burrows-Wheeler transform, held in a wavelet
tree of rank-counted bit rows.  All phrases are searched backwards at once, one word per step, two
ranks per bit level; the suffix ranges left over are located by walking to the nearest sampled
suffix position.  The located spans are merged per document.

A word that no phrase has cannot lie in an occurrence, so the shard's text is cut there, and pieces
shorter than the shortest phrase are left out of the index; nothing that could match is lost.

Phrases are sent to the tasks in blocks of at most ``block_bytes`` of text (measured, whatever the benchmark's
size; in memory some twenty times that; a larger single item is a block of its own), one block at a time: with
more than one, each is one pass over the documents and the passes are merged per document.

Defined cases: null or empty texts and items have no words; an item id that repeats counts once, a
null item id marks words but is not listed; repeated or null document ids are judged row by row;
other columns come back untouched; empty tables give empty or unmarked results.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridegrid.llm import common as C
from ridegrid.llm.quality_rules import suffix_order
from ridegrid.session import reliable_checkpoint

WINDOW = 13
#: Every this-many-th suffix position is kept for locating.
SAMPLE = 8
#: Bytes of benchmark text in one broadcast block.
BLOCK_BYTES = 4 << 20
#: Text in one slice, each of which has its own index.
SLICE_BYTES = 1 << 20

RESULT = "n_words long, spans array<struct<start:bigint,end:bigint>>, items array<string>"


class BitRow:
    """A bit sequence with the number of ones before each place."""

    def __init__(self, bits: np.ndarray):
        self.ones = np.zeros(len(bits) + 1, dtype=np.int32)
        np.cumsum(bits, out=self.ones[1:])
        self.zeros = len(bits) - int(self.ones[-1])


class FMIndex:
    """Counting and locating of word sequences in a sequence of word numbers (0 ends the text)."""

    def __init__(self, codes: np.ndarray, sample: int = SAMPLE):
        text = np.append(codes, 0)
        n = len(text)
        order, _ = suffix_order(text, np.full(n, n))
        bwt = text[order - 1]
        size = int(text.max()) + 1
        self.before = np.zeros(size + 1, dtype=np.int64)  # words smaller than each word
        np.cumsum(np.bincount(text, minlength=size), out=self.before[1:])
        self.levels = max(1, (size - 1).bit_length())
        self.tree: list[BitRow] = []  # wavelet matrix: zeros of each level go to the front
        row = bwt
        for level in range(self.levels - 1, -1, -1):
            bits = (row >> level) & 1
            self.tree.append(BitRow(bits))
            row = np.concatenate((row[bits == 0], row[bits == 1]))
        self.size, self.n, self.sample = size, n, sample
        kept = order % sample == 0
        self.sampled = BitRow(kept)
        self.positions = order[kept]

    def rank(self, word: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Occurrences of each ``word`` in the transform before each ``place``."""
        low, at = np.zeros_like(place), place.copy()
        for row, level in zip(self.tree, range(self.levels - 1, -1, -1), strict=True):
            one = ((word >> level) & 1).astype(bool)
            low = np.where(one, row.zeros + row.ones[low], low - row.ones[low])
            at = np.where(one, row.zeros + row.ones[at], at - row.ones[at])
        return at - low

    def access(self, place: np.ndarray) -> np.ndarray:
        word, at = np.zeros_like(place), place.copy()
        for row in self.tree:
            one = row.ones[at + 1] - row.ones[at]
            word = (word << 1) | one
            at = np.where(one == 1, row.zeros + row.ones[at], at - row.ones[at])
        return word

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges of phrases; ``phrases`` holds each one's words from its end backwards."""
        lo, hi = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n, dtype=np.int64)
        live = np.arange(len(phrases))
        for step in range(int(lengths.max(initial=0))):
            live = live[(step < lengths[live]) & (lo[live] < hi[live])]
            word = phrases[live, step]
            lo[live] = self.before[word] + self.rank(word, lo[live])
            hi[live] = self.before[word] + self.rank(word, hi[live])
        return lo, hi

    def locate(self, place: np.ndarray) -> np.ndarray:
        """Text positions of suffixes, by steps back to a sampled one."""
        out, steps = np.zeros_like(place), np.zeros_like(place)
        at, open_ = place.copy(), np.arange(len(place))
        while open_.size:
            here = at[open_]
            hit = self.sampled.ones[here + 1] > self.sampled.ones[here]
            done = open_[hit]
            out[done] = self.positions[self.sampled.ones[at[done]]] + steps[done]
            open_ = open_[~hit]
            here = at[open_]
            word = self.access(here)
            at[open_] = self.before[word] + self.rank(word, here)
            steps[open_] += 1
        return out


class Phrases:
    """The distinct phrases of one block of items, as word sequences."""

    def __init__(self, items: list[tuple[object, str]], window: int):
        w = C.words_of(pa.array([t for _, t in items], pa.string()), word_bytes=C.ALNUM)
        self.words = w.vocab
        found: dict[bytes, list] = {}
        wide = w.codes.astype(np.int32)
        for i, (item, _) in enumerate(items):
            a, b = int(w.offsets[i]), int(w.offsets[i + 1])
            for s in range(a, max(a + 1, b - window + 1)) if b > a else ():
                key = wide[s:min(s + window, b)].tobytes()
                found.setdefault(key, []).append(item)
        self.lengths = np.array([len(k) // 4 for k in found], dtype=np.int64)
        self.back = np.zeros((len(found), window), dtype=np.int64)  # words from the end backwards
        for i, key in enumerate(found):
            codes = np.frombuffer(key, np.int32)
            self.back[i, :len(codes)] = codes[::-1]
        self.items = [sorted({str(x) for x in v if x is not None}) for v in found.values()]
        self.shortest = int(self.lengths.min()) if found else 0


def _mark(words: C.Words, phrases: Phrases):
    """(first word, length, phrase) of every occurrence in a slice of documents."""
    none = np.zeros(0, np.int64)
    if not words.n or not len(phrases.lengths):
        return none, none, none
    import pyarrow.compute as pc

    known = pc.index_in(words.vocab, value_set=phrases.words).fill_null(-1).to_numpy(zero_copy_only=False)
    code = known.astype(np.int64)[words.codes]
    first = np.zeros(words.n, dtype=bool)
    first[words.offsets[:-1][words.counts > 0]] = True
    # pieces: runs of known words inside one document
    start = np.flatnonzero(first | (code < 0) | np.concatenate(([False], code[:-1] < 0)))
    length = np.diff(np.append(start, words.n))
    keep = (code[start] >= 0) & (length >= phrases.shortest)
    start, length = start[keep], length[keep]
    if not len(start):
        return none, none, none
    # the pieces in one sequence; 1 parts them, known words begin at 2
    at = np.cumsum(length + 1) - (length + 1)
    text = np.ones(int((length + 1).sum()), dtype=np.int64)
    source = np.full(len(text), -1, dtype=np.int64)
    inside = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
    slot = np.repeat(at, length) + inside
    source[slot] = np.repeat(start, length) + inside
    text[slot] = code[source[slot]] + 2
    index = FMIndex(text)
    back = phrases.back + 2
    present = np.zeros(max(index.size, int(back.max()) + 1), dtype=bool)
    present[text] = True
    used = np.arange(back.shape[1]) < phrases.lengths[:, None]
    able = np.flatnonzero((present[back] | ~used).all(axis=1))
    lo, hi = index.search(back[able], phrases.lengths[able])
    count = np.maximum(hi - lo, 0)
    place = np.repeat(lo, count) + np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    phrase = np.repeat(able, count)
    return source[index.locate(place)], phrases.lengths[phrase], phrase


def _judge(shared, place: int | None = None):
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        phrases = shared.value
        for batch in C.text_slices(C.with_text(batches, place), "_text", SLICE_BYTES):
            w = C.words_of(batch.column("_text"), word_bytes=C.ALNUM)
            at, length, phrase = _mark(w, phrases)
            hit = C.cover(at, length, w.n)
            first = np.zeros(w.n + 1, dtype=bool)
            first[w.offsets] = True  # merged spans end with their document
            s = np.flatnonzero(hit & (first[:-1] | ~np.concatenate(([False], hit[:-1]))))
            e = np.flatnonzero(hit & (first[1:] | ~np.concatenate((hit[1:], [False])))) + 1
            doc = w.doc()
            spans = [[] for _ in range(batch.num_rows)]
            for a, b in zip(s.tolist(), e.tolist(), strict=True):
                d = int(doc[a])
                spans[d].append({"start": a - int(w.offsets[d]), "end": b - int(w.offsets[d])})
            items = [set() for _ in range(batch.num_rows)]
            if len(at):
                for d, p in np.unique(np.stack((doc[at], phrase), axis=1), axis=0).tolist():
                    items[d].update(phrases.items[p])
            yield pa.RecordBatch.from_arrays(
                [batch.column("_row"), pa.array(w.counts, pa.int64()), pa.array(spans, span),
                 pa.array([sorted(x) for x in items], pa.list_(pa.string()))],
                names=["_row", "n_words", "spans", "items"])

    return run


def _blocks(benchmark: DataFrame, item_id: str, text: str, block_bytes: int) -> tuple[int, Iterator[list]]:
    """(number of blocks, lists of (item, text) read from the table one block at a time).

    Blocks are measured before one is read: none exceeds ``block_bytes`` but by a single item.  Equal rows count once.
    """
    items = benchmark.select(F.col(item_id).alias("_item"), F.coalesce(F.col(text), F.lit("")).alias("_text")).distinct()
    size = F.octet_length("_text")
    n = 1 + (items.agg(F.sum(size)).first()[0] or 0) // block_bytes
    while True:
        block = F.pmod(F.xxhash64("_item", "_text"), F.lit(n))
        sizes = items.groupBy(block.alias("i")).agg(F.sum(size).alias("bytes"), F.count("*").alias("rows"))
        if n == 1 or sizes.where((F.col("bytes") > block_bytes) & (F.col("rows") > 1)).isEmpty():
            break
        n *= 2
    return n, ([(r["_item"], r["_text"]) for r in items.where(block == i).collect()] for i in range(n))


def find_contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
                       item_text: str = "text", window: int = WINDOW,
                       block_bytes: int = BLOCK_BYTES, keep=None) -> DataFrame:
    """Every row of ``docs`` (struct ``_row``, of the columns in ``keep``, all by default): n_words,
    merged ``spans`` of hit words, and ``items``."""
    sc = docs.sparkSession.sparkContext
    n, parts = _blocks(benchmark, item_id, item_text, block_bytes)
    if n == 1:
        df, row, place = C.carried_once(docs, text, keep)
        return C.map_arrow(df, _judge(sc.broadcast(Phrases(next(parts), window)), place), f"_row {row}, {RESULT}")
    df, _ = C.carried(docs, text, keep)
    numbered = reliable_checkpoint(df.withColumn("_n", F.monotonically_increasing_id()), "decontamination")
    wrapped = numbered.select(F.struct("_row", "_n").alias("_row"), "_text")
    row = C.ddl(wrapped.schema["_row"].dataType)
    every = None
    for part in parts:
        shared = sc.broadcast(Phrases(part, window))
        seen = C.map_arrow(wrapped, _judge(shared), f"_row {row}, {RESULT}")
        seen = reliable_checkpoint(seen.select("_row._n", "n_words", "spans", "items"), "decontamination")
        shared.unpersist()  # written: this block is not needed again
        every = seen if every is None else every.unionByName(seen)
    hits = every.groupBy("_n").agg(F.max("n_words").alias("n_words"),
                                   F.flatten(F.collect_list("spans")).alias("spans"),
                                   F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    return numbered.join(hits, "_n").select("_row", "n_words", merged("spans").alias("spans"), "items")


def merged(spans: str):
    """Overlapping or touching spans joined, in order."""
    empty = F.array().cast("array<struct<start:bigint,end:bigint>>")

    def add(done, s):
        last = F.element_at(done, -1)
        joins = (F.size(done) > 0) & (s["start"] <= F.coalesce(last["end"], F.lit(-1)))
        wider = F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))
        return F.when(joins, F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(wider))
                      ).otherwise(F.concat(done, F.array(s)))

    return F.aggregate(F.array_sort(spans), empty, add)


def n_hit():
    return F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])


def contaminated():
    """Some words are hit, and at least a twentieth of them."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, unchanged."""
    found = find_contamination(docs, benchmark).withColumn("n_hit", n_hit())
    return found.where(~contaminated()).select("_row.*")


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_contamination(C.table(spark, sf_dir, "documents"), C.table(spark, sf_dir, "benchmark"),
                               keep=["doc_id"]).withColumn("n_hit", n_hit())
    return found.select(F.col("_row.doc_id").alias("doc_id"), "n_words", "n_hit",
                        F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        contaminated().alias("contaminated"))
