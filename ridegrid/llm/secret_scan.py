"""Operator 3, secret scans: pattern spans plus a token-efficiency test for random strings.

A byte-pair vocabulary learnt from real text spends few tokens on words and many on random
strings.  Runs of credential characters are cut at the pattern spans and at UUIDs, and what is left at
punctuation; each part is encoded with a tiktoken vocabulary.  Parts with few characters per token are
reported as ``random``, neighbours in one span (base 64 holds punctuation), unless they are known
digests or identifiers (hex digests, plain numbers, words that the vocabulary knows).  The vocabulary file must
lie at the same path on every executor.

Defined cases: a null or empty text has no spans; repeated rows and null ids are scanned row by
row; the whole text is scanned whatever its length; other columns come back untouched; an empty
table gives an empty result.  Span positions are code points, end exclusive.
"""
from __future__ import annotations

import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridegrid.llm import common as C

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The pre-split pattern that belongs to the vocabulary (fixed value).
SPLIT = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Fixed patterns of the base scan.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # runs are maximal, so shorter ones may be skipped at once
KINDS = ("assign", "access", "hex", "random")

#: Candidates of the token-efficiency test.
RUN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
#: Least characters of a part of a run (measured: of 2,000 random alphanumeric strings each, none is missed from
#: 12 characters on, and no part of the texts and pages at sf0.01 is reported at any bound from 12 to 20).
LEAST = 16
PART = re.compile(r"[A-Za-z0-9]+")
JOINTS = "+/_=-"
UUID = re.compile(r"(?<![0-9A-Za-z])[0-9A-Fa-f]{8}-(?:[0-9A-Fa-f]{4}-){3}[0-9A-Fa-f]{12}(?![0-9A-Za-z])")
#: Words of fewer letters say nothing of their own.
WORD = 4
#: A part shorter than this says nothing of its own; below LEAST a part is ordinary from SHORT_RATIO on.
SHORT, SHORT_RATIO = 4, 2.6
DIGEST = re.compile(r"(?:0x)?[0-9A-Fa-f]+")
NUMBER = re.compile(r"[0-9+/_=-]+")

SPAN = "array<struct<kind:string,start:bigint,end:bigint>>"


def load_vocabulary(path: str):
    import base64

    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("vocabulary", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=2)
def vocabulary(path: str):
    """One encoder per worker process."""
    return load_vocabulary(path)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the pattern matches that pass their length test."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    found.sort()
    return found


def known_identifier(run: str, encode, max_ratio: float) -> bool:
    """Digests, numbers and ordinary words joined by punctuation (paths, slugs, dates) are not secrets of their own.

    Words are letters in one case or with one leading capital.  Those of ``WORD`` letters or more must together be
    ordinary to the vocabulary, in small letters; a random string in one case is not.
    """
    if DIGEST.fullmatch(run) or NUMBER.fullmatch(run):
        return True
    words = []
    for p in re.split(r"[+/_=-]+", run):
        if p.isalpha() and (p.islower() or p.isupper() or p[0].isupper() and p[1:].islower()):
            words.append(p.lower())
        elif p and not p.isdigit():
            return False
    words = [w for w in words if len(w) >= WORD]
    letters = sum(map(len, words))
    return letters < LEAST or letters > max_ratio * sum(len(encode(w)) for w in words)


def gaps(start: int, end: int, spans) -> list[tuple[int, int]]:
    """What ``spans`` (in order of their starts) leave of start to end."""
    out = []
    for s, e in spans:
        if s > start:
            out.append((start, min(s, end)))
        start = max(start, e)
    return [(s, e) for s, e in [*out, (start, end)] if s < e]


def random_spans(text: str, taken: list[tuple[int, int, int]], encode, max_ratio: float
                 ) -> list[tuple[int, int, int]]:
    def is_random(run: str) -> bool:
        return len(run) >= LEAST and not known_identifier(run, encode, max_ratio) and len(run) <= max_ratio * len(encode(run))

    def ordinary(part: str) -> bool:
        limit = max_ratio if len(part) >= LEAST else SHORT_RATIO
        return len(part) >= SHORT and (known_identifier(part, encode, max_ratio) or len(part) > limit * len(encode(part)))

    def search(start: int, end: int) -> list[tuple[int, int]]:
        parts = [(p.start(), p.end()) for p in PART.finditer(text, start, end)]
        groups, open_ = [], False
        for s, e in parts:
            if ordinary(text[s:e]):
                open_ = False
            elif open_:
                groups[-1].append((s, e))
            else:
                groups.append([(s, e)])
                open_ = True
        if len(groups) == 1 and len(groups[0]) == len(parts):
            return [(start, end)] if is_random(text[start:end]) else []
        got = [(g[0][0], g[-1][1]) for g in groups if is_random(text[g[0][0]:g[-1][1]])]
        return got or ([(start, end)] if is_random(text[start:end]) else [])

    found, at = [], 0
    merged: list[list[int]] = []
    for s, _, e in taken:
        if merged and s <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], e)
        else:
            merged.append([s, e])
    for m in RUN.finditer(text):
        while at < len(merged) and merged[at][1] <= m.start():
            at += 1
        to = at
        while to < len(merged) and merged[to][0] < m.end():
            to += 1
        for start, end in gaps(m.start(), m.end(), merged[at:to]):
            known = [u.span() for u in UUID.finditer(text, start, end)]
            for a, b in gaps(start, end, known):
                # punctuation beside a cut belongs to neither side
                a = b - len(text[a:b].lstrip(JOINTS)) if a > m.start() else a
                b = a + len(text[a:b].rstrip(JOINTS)) if b < m.end() else b
                found += [(s, 3, e) for s, e in search(a, b)]
    return found


def _scan(path: str, max_ratio: float):
    def run(batches):
        encode = None
        for batch in batches:
            base, every = [], []
            for text in batch.column("_text"):
                t = text.as_py() or ""
                own = base_spans(t)
                if encode is None:
                    encode = vocabulary(path).encode_ordinary
                more = random_spans(t, sorted(own), encode, max_ratio)
                base.append([{"kind": KINDS[k], "start": s, "end": e} for s, k, e in own])
                every.append([{"kind": KINDS[k], "start": s, "end": e} for s, k, e in sorted(own + more)])
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("_row"), pa.array(base, kind), pa.array(every, kind)],
                names=["_row", "base_spans", "spans"])

    return run


def find_secrets(docs: DataFrame, text: str = "text", vocabulary_path: str = VOCABULARY,
                 max_ratio: float = 2.1, keep=None) -> DataFrame:
    """Every row of ``docs`` (struct ``_row``, of the columns in ``keep``, all by default) with
    ``base_spans`` and all ``spans``.

    ``max_ratio``: characters per token at or below which a run counts as random; random base-64
    text lies near 1.6, words of any European language above 2.4.
    """
    df, row = C.carried(docs, text, keep)
    return C.map_arrow(df, _scan(vocabulary_path, max_ratio),
                         f"_row {row}, base_spans {SPAN}, spans {SPAN}")


def joined(spans: str):
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def op3_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(C.table(spark, sf_dir, "documents"), keep=["doc_id"])

    def count(kind):
        return F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(F.col("_row.doc_id").alias("doc_id"), count("assign"), count("access"), count("hex"),
                        F.sha2(joined("base_spans"), 256).alias("base_sha256"),
                        joined("spans").alias("spans"))
