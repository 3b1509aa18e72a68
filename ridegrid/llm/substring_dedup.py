"""Operator 9, substring dedup by seed and extend.

A window is ``window`` consecutive words.  Seeds are winnowed anchors: in every window the
rightmost smallest hash of its ``seed``-word runs.  Two equal windows have the same anchor, so
anchors that occur once need no further look.  Repeated anchors are extended to both sides over
all windows that chose them; the extension's hash divides an anchor's occurrences into classes of
equal matches.  Of each class the earliest occurrence is the one the others match, so a later one
is a repeat as a whole, without being paired with each other member.  Earliest members of different
classes of one anchor may still share part of their extension: these few compare window by window.
Matched windows that touch or overlap are one maximal repeat; a repeat shorter than the window does
not exist by construction.

Texts equal in full are set aside first: the later ones are repeats from end to end.

Defined cases: a null, empty or short text has no window and keeps its words; rows that repeat an
id are ordered by their text's hash, and a row equal to another in id and text is the same row
(both get the first one's result); a null id comes after all others; an empty table gives an empty
result; other columns are ignored.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridegrid.llm import common as C
from ridegrid.session import reliable_checkpoint

WINDOW = 20
SEED = 8
LAST = (1 << 63) - 1
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _anchors(w: C.Words, window: int, seed: int):
    """Anchor runs: (hash of the anchor, place of the anchor, first window, last window)."""
    h = C.rolling(w.hashes(), seed)
    if len(h) < window - seed + 1:
        none = np.zeros(0, np.int64)
        return h[:0], none, none, none
    # smallest wins, then the rightmost: the low bits count down along the text
    place = np.arange(len(h), dtype=np.uint64)
    key = (h & ~np.uint64(0xFFFF)) | (np.uint64(0xFFFF) - (place & np.uint64(0xFFFF)))
    span, best, at = window - seed + 1, key, place.astype(np.int64)
    done = 1
    while done < span:  # sliding minimum by doubling
        step = min(done, span - done)
        a, b = best[:-step], best[step:]
        right = b < a
        best = np.where(right, b, a)
        at = np.where(right, at[step:], at[:-step])
        done += step
    starts = np.flatnonzero(w.left()[:len(at)] >= window)
    chosen = at[starts]
    head = np.ones(len(starts), dtype=bool)
    head[1:] = (chosen[1:] != chosen[:-1]) | (starts[1:] != starts[:-1] + 1)
    first = np.flatnonzero(head)
    last = np.append(first[1:], len(starts)) - 1
    return h[chosen[first]], chosen[first], starts[first], starts[last]


def _span_hashes(hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of the words from each start to each end, from sums of weighted word hashes."""
    n = len(hashes)
    power = np.full(n + 1, C.ODD, dtype=np.uint64)
    back = np.full(n + 1, INVERSE, dtype=np.uint64)
    power[:1] = back[:1] = 1
    np.cumprod(power, out=power)
    np.cumprod(back, out=back)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(hashes * power[:n], out=total[1:])
    return C.mix((total[ends] - total[starts]) * back[starts]) ^ C.mix((ends - starts).astype(np.uint64))


OTHER = 0x2545F4914F6CDD1D


def _occurrences(window: int, seed: int, full: bool):
    """Rows of anchors: the hash alone, or with extension, row and place."""
    schema = pa.schema([("anchor", pa.int64())] + ([
        ("ext", pa.int64()), ("k", pa.int64()), ("h", pa.int64()), ("first", pa.int32()), ("n", pa.int32())]
        if full else []))

    def run(batches):
        for batch in C.text_slices(batches, "text"):
            w = C.words_of(batch.column("text"), lower=False)
            anchor, at, a, b = _anchors(w, window, seed)
            if not full:
                yield C.rows(schema, anchor.view(np.int64))
                continue
            # the extension, and where the anchor lies in it
            ext = _span_hashes(w.hashes(OTHER), a, b + window) ^ C.mix((at - a).astype(np.uint64) + C.ODD)
            doc = w.doc()[a] if len(a) else a
            yield C.rows(schema, anchor.view(np.int64), ext.view(np.int64),
                         batch.column("k").to_numpy()[doc], batch.column("h").to_numpy()[doc],
                         (a - w.offsets[doc]).astype(np.int32),
                         (b - a + 1).astype(np.int32))

    return run


def _windows(window: int):
    """The windows of a text that start in its ``spans``, by two hashes."""
    schema = pa.schema([("w1", pa.int64()), ("w2", pa.int64()), ("k", pa.int64()), ("h", pa.int64()),
                        ("first", pa.int32())])

    def run(batches):
        for batch in C.text_slices(batches, "text"):
            w = C.words_of(batch.column("text"), lower=False)
            starts, docs = [], []
            for d, spans in enumerate(batch.column("spans").to_pylist()):
                for s in spans:
                    starts.append(np.arange(s["first"], s["first"] + s["n"]) + w.offsets[d])
                    docs.append(np.full(s["n"], d))
            at = np.concatenate(starts) if starts else np.zeros(0, np.int64)
            doc = np.concatenate(docs) if docs else at
            one, two = (_span_hashes(w.hashes(seed), at, at + window) for seed in (0, OTHER))
            yield C.rows(schema, one.view(np.int64), two.view(np.int64), batch.column("k").to_numpy()[doc],
                         batch.column("h").to_numpy()[doc], (at - w.offsets[doc]).astype(np.int32))

    return run


def _cut(window: int):
    def run(batches):
        for batch in C.text_slices(batches, "text"):
            w = C.words_of(batch.column("text"), lower=False)
            gone = np.zeros(w.n, dtype=bool)
            for d, spans in enumerate(batch.column("spans").to_pylist()):
                for s in spans or ():
                    a = int(w.offsets[d]) + s["first"]
                    gone[a:a + s["n"] + window - 1] = True
            kept, spans = [], []
            raw = w.data.tobytes()
            for d in range(batch.num_rows):
                a, b = int(w.offsets[d]), int(w.offsets[d + 1])
                left = a + np.flatnonzero(~gone[a:b])
                kept.append(b" ".join([raw[s:e] for s, e in zip(w.starts[left].tolist(), w.ends[left].tolist(),
                                                                strict=True)]).decode())
                s, e = C.runs(gone[a:b])
                spans.append([{"start": x, "end": y} for x, y in zip(s.tolist(), e.tolist(), strict=True)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("k"), batch.column("m"), pa.array(w.counts, pa.int64()), pa.array(kept, pa.string()),
                 pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
                names=["k", "m", "n_words", "kept_text", "repeats"])

    return run


def drop_repeated_passages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                           window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_removed, kept_text and the maximal ``repeats`` (word spans) of every row."""
    base = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST)).alias("_k"),
                       F.coalesce(F.col(text), F.lit("")).alias("text"))
    # distinct texts, each under its smallest id; written once, by (k, h), which names and orders them
    texts = base.groupBy("text").agg(F.min("_k").alias("k"))
    texts = C.clustered(texts.select("k", F.xxhash64("text").alias("h"), "text"), ["k", "h"], "passages")

    anchors = C.map_arrow(texts.select("text"), _occurrences(window, seed, False), "anchor long")
    again = reliable_checkpoint(anchors.groupBy("anchor").agg(F.count("*").alias("c")).where("c > 1"), "repeated-anchors")
    found = C.map_arrow(texts, _occurrences(window, seed, True),
                        "anchor long, ext long, k long, h long, first int, n int")
    own = ["k", "h", "first"]
    found = reliable_checkpoint(C.join_hot(found, again, ["anchor"], own), "anchors")
    place = F.struct(*own)
    classes = found.groupBy("anchor", "ext").agg(F.min(place).alias("earliest"), F.count("*").alias("c"))
    classes = reliable_checkpoint(classes, "anchor-classes")
    # an anchor with one class is settled; among several, their earliest members are compared
    mixed = classes.groupBy("anchor").agg(F.count("*").alias("c")).where("c > 1").select(
        "anchor", F.lit(True).alias("mixed"))
    later = C.join_hot(found, classes, ["anchor", "ext"], own).where(place != F.col("earliest")).select(*own, "n")
    later = reliable_checkpoint(later, "later-anchors")
    size = found.groupBy("anchor", "ext").agg(F.min(F.struct("k", "h", "first", "n")).alias("at"))
    part = size.join(mixed, "anchor").select("at.k", "at.h", "at.first", "at.n")
    spans = F.collect_list(F.struct("first", "n")).alias("spans")
    windows = C.map_arrow(texts.join(part.groupBy("k", "h").agg(spans), ["k", "h"]), _windows(window),
                          "w1 long, w2 long, k long, h long, first int")
    windows = reliable_checkpoint(windows, "windows")
    earliest = windows.groupBy("w1", "w2").agg(F.min(place).alias("earliest"), F.count("*").alias("c")).where("c > 1")
    single = windows.join(earliest, ["w1", "w2"]).where(place != F.col("earliest")).select(
        "k", "h", "first", F.lit(1).alias("n"))
    gone = later.unionByName(single).groupBy("k", "h").agg(spans)
    cut = C.map_arrow(texts.join(gone, ["k", "h"], "left").select("k", F.md5("text").alias("m"), "text", "spans"), _cut(window),
                      "k long, m string, n_words long, kept_text string, "
                      "repeats array<struct<start:bigint,end:bigint>>")
    cut = cut.select(F.col("k").alias("_first"), F.col("m").alias("_m"), "n_words", "kept_text", "repeats")
    # a text equal to an earlier one is a repeat from end to end, if it has a window at all
    out = base.select("doc_id", "_k", F.md5("text").alias("_m")).join(cut, "_m")
    copy = (F.col("_k") > F.col("_first")) & (F.col("n_words") >= window)
    removed = F.aggregate("repeats", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    every = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_words").alias("end")))
    return out.select("doc_id", "n_words", F.when(copy, F.col("n_words")).otherwise(removed).alias("n_removed"),
                      F.when(copy, "").otherwise(F.col("kept_text")).alias("kept_text"),
                      F.when(copy, every).otherwise(F.col("repeats")).alias("repeats"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = drop_repeated_passages(C.table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text"), 256).alias("kept_sha256"))
