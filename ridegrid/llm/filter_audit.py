"""Operator 13, filter interaction audit by a table-driven byte transducer.

One pass over a text's UTF-8 bytes feeds a two-state machine (outside or inside a word): ``NEXT`` gives
the state after a byte, ``OUT`` what that step emits (word begins, word ends, capital, continuation of
a code point, symbol).  The state after a byte does not depend on the state before it, so all states of
a block come from one look-up and the emissions from another.  The spans of the words that end go into
an open-addressing hash table, which finds a text's distinct words; equal hashes count as equal words
only after their bytes have been compared.  A long text passes in blocks: state, an unfinished word and
the table are carried from one to the next, so memory follows the block and the distinct words.

Five filters judge every document; a filter's effect depends on those before it, so the audit replays
all orders of them.  Documents are first counted by part and set of failed filters (at most 32 sets a
part); the 120 orders are replayed on these counts.  Copies of a text are found by its SHA-256: the
smallest id of each digest is taken by a grouped minimum (combined before the shuffle), and the holders
of it are counted by a join on digest and id, so a text held by a third of all rows is no hot key.

Defined cases: a null text is empty, and equal to other empty ones; a null part is the empty string; a
null id is never a copy and never the one that others copy; rows that repeat an id are documents of
their own, and no copies of each other; a label row that repeats an id adds to it (good if any row says
so); an empty table gives an empty result; other columns are ignored, whatever they are called.
"""
from __future__ import annotations

import json
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridegrid.llm import common as C
from ridegrid.session import reliable_checkpoint

#: The characters of the symbol filter, and the limits of the filters.
SYMBOLS = b"#$%&*|"
MIN_WORDS = 200
MIN_DISTINCT_PERCENT = 50
MAX_CAPITAL_PERCENT = 3

FILTERS = "ABCDE"
OUTSIDE, INSIDE = 0, 1
BEGINS, ENDS, CAPITAL, CONTINUES, SYMBOL = 1, 2, 4, 8, 16
#: Bytes that pass the machine at a time, and the longest word that is hashed eight bytes at a time.
BLOCK_BYTES = 4 << 20
LONG_WORD = 256


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """(state after a byte, emissions of each state and byte)."""
    byte = np.arange(256)
    following = np.where(C.NOT_SPACE, INSIDE, OUTSIDE).astype(np.uint8)
    always = (CAPITAL * ((byte >= 65) & (byte <= 90)) + CONTINUES * ((byte >= 0x80) & (byte <= 0xBF))
              + SYMBOL * np.isin(byte, list(SYMBOLS)))
    emits = np.stack([always + BEGINS * (following == INSIDE), always + ENDS * (following == OUTSIDE)])
    return following, emits.astype(np.uint8)


NEXT, OUT = _tables()
#: The lowest 0 to 8 bytes of a word of eight.
LOW_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=np.uint64)


def eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place of ``data`` as one number (beyond the end: zeros)."""
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    return np.ndarray(len(data) + 1, dtype="<u8", buffer=padded.data, strides=(1,))


class WordTable:
    """Distinct (text, word) pairs of a slice of texts, as word spans in an open-addressing table."""

    def __init__(self, data: np.ndarray, size: int = 1 << 12):
        self.data, self.wide = data, eights(data)
        self.slots = np.full(size, -1, dtype=np.int64)
        self.n = 0
        self.hash, self.text, self.start, self.length = (
            np.zeros(size, kind) for kind in (np.uint64, np.int64, np.int64, np.int64))

    def _part(self, start: np.ndarray, length: np.ndarray, at: int) -> np.ndarray:
        return self.wide[start + at] & LOW_BYTES[np.minimum(length - at, 8)]

    def hashes(self, text: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        out = C.mix(text.astype(np.uint64) * C.ODD + length.astype(np.uint64))
        active = np.flatnonzero(length <= LONG_WORD)
        for at in range(0, LONG_WORD, 8):
            active = active[length[active] > at]
            if not len(active):
                break
            out[active] = C.mix(out[active] ^ self._part(start[active], length[active], at)) * C.ODD
        for i in np.flatnonzero(length > LONG_WORD):
            out[i] ^= np.uint64(hash(self.data[start[i]:start[i] + length[i]].tobytes()) & (2**64 - 1))
        return out

    def _same_bytes(self, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
        same = np.ones(len(a), dtype=bool)
        active = np.flatnonzero(length <= LONG_WORD)
        for at in range(0, LONG_WORD, 8):
            active = active[length[active] > at]
            if not len(active):
                break
            equal = self._part(a[active], length[active], at) == self._part(b[active], length[active], at)
            same[active[~equal]] = False
            active = active[equal]
        for i in np.flatnonzero(length > LONG_WORD):
            same[i] = np.array_equal(self.data[a[i]:a[i] + length[i]], self.data[b[i]:b[i] + length[i]])
        return same

    def _reserve(self, more: int):
        """Room for ``more`` entries at half load at most."""
        size = len(self.slots)
        while size < 2 * (self.n + more):
            size *= 2
        if size == len(self.slots):
            return
        for name in ("hash", "text", "start", "length"):
            old = getattr(self, name)
            setattr(self, name, np.concatenate((old[:self.n], np.zeros(size - self.n, old.dtype))))
        self.slots = np.full(size, -1, dtype=np.int64)
        left = np.arange(self.n)  # known to be distinct
        at = (self.hash[:self.n] & np.uint64(size - 1)).astype(np.int64)
        while len(left):
            free = self.slots[at] < 0
            self.slots[at[free]] = left[free]
            stay = self.slots[at] != left
            left, at = left[stay], (at[stay] + 1) & (size - 1)

    def add(self, text: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Insert word spans; the texts of those that were not there yet, once for each."""
        self._reserve(len(text))
        own, mask = self.n + np.arange(len(text)), len(self.slots) - 1
        h = self.hashes(text, start, length)
        self.hash[own], self.text[own], self.start[own], self.length[own] = h, text, start, length
        fresh = np.zeros(len(text), dtype=bool)
        left, at = np.arange(len(text)), (h & np.uint64(mask)).astype(np.int64)
        while len(left):
            free = self.slots[at] < 0
            self.slots[at[free]] = own[left[free]]  # one of those that meet here stays
            holder = self.slots[at]
            won = holder == own[left]
            fresh[left[won]] = True
            met = ~won & (self.hash[holder] == h[left]) & (self.text[holder] == text[left]) & (
                self.length[holder] == length[left])
            check = np.flatnonzero(met)
            met[check] = self._same_bytes(start[left[check]], self.start[holder[check]], length[left[check]])
            stay = ~won & ~met
            left, at = left[stay], (at[stay] + 1) & mask
        # entries close up: the new ones take the next numbers
        number = np.full(len(text), -1, dtype=np.int64)
        number[fresh] = self.n + np.arange(int(fresh.sum()))
        place = np.flatnonzero(self.slots >= self.n)
        self.slots[place] = number[self.slots[place] - self.n]
        kept = own[fresh]
        for column in (self.hash, self.text, self.start, self.length):
            column[self.n:self.n + len(kept)] = column[kept]
        self.n += len(kept)
        return text[fresh]


def measures(texts: pa.Array, block: int = BLOCK_BYTES) -> dict[str, np.ndarray]:
    """n_words, n_distinct, n_capitals, n_code_points and n_symbols of each text."""
    data, off = C.utf8(texts)
    n = len(texts)
    words, distinct, capitals, continued, symbols = (np.zeros(n, np.int64) for _ in range(5))
    table = WordTable(data)
    begun = np.zeros(0, np.int64)  # the start of a word that has not ended yet
    for a in range(0, len(data), block):
        b = min(a + block, len(data))
        after = NEXT[data[a:b]]
        before = np.empty(b - a, np.uint8)
        before[1:] = after[:-1]
        before[0] = NEXT[data[a - 1]] if a else OUTSIDE
        first, last = np.searchsorted(off, [a, b])
        before[off[first:last] - a] = OUTSIDE  # each text starts anew
        out = OUT[before, data[a:b]]
        for flag, total in ((CAPITAL, capitals), (CONTINUES, continued), (SYMBOL, symbols)):
            total += np.diff(np.searchsorted(np.flatnonzero(out & flag) + a, off))
        closing = off[1:][(off[1:] > a) & (off[1:] <= b) & (off[1:] > off[:-1])]
        closing = closing[NEXT[data[closing - 1]] == INSIDE]  # a text's end ends its word
        ends = np.sort(np.concatenate((np.flatnonzero(out & ENDS) + a, closing)))
        starts = np.concatenate((begun, np.flatnonzero(out & BEGINS) + a))
        starts, begun = starts[:len(ends)], starts[len(ends):]
        text = np.searchsorted(off, starts, side="right") - 1
        words += np.bincount(text, minlength=n)
        distinct += np.bincount(table.add(text, starts, ends - starts), minlength=n)
    return {"n_words": words, "n_distinct": distinct, "n_capitals": capitals,
            "n_code_points": np.diff(off) - continued, "n_symbols": symbols}


MEASURES = ("n_words", "n_distinct", "n_capitals", "n_code_points", "n_symbols")


def _measure(batches):
    for batch in C.text_slices(batches, "_text"):
        found = measures(batch.column("_text"))
        yield pa.RecordBatch.from_arrays([batch.column("_row"), *[pa.array(found[m], pa.int64()) for m in MEASURES]],
                                         names=["_row", *MEASURES])


def measured(docs: DataFrame, text: str = "text", keep=None) -> DataFrame:
    """Every row of ``docs`` (struct ``_row``, of the columns in ``keep``, all by default) and its measures."""
    df, kind = C.carried(docs, text, keep)
    return C.map_arrow(df, _measure, f"_row {kind}, " + ", ".join(f"{m} long" for m in MEASURES))


def failed_alone() -> list:
    """The conditions of the filters that look at one document, first to fourth."""
    return [F.col("n_words") < MIN_WORDS,
            100 * F.col("n_distinct") < MIN_DISTINCT_PERCENT * F.col("n_words"),
            100 * F.col("n_capitals") > MAX_CAPITAL_PERCENT * F.col("n_code_points"),
            F.col("n_symbols") > 0]


def failure_counts(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
                   part: str = "lang") -> DataFrame:
    """(part, failed, n, good, toxic): documents by part and set of failed filters (bit i: filter i)."""
    slim = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(part), F.lit("")).alias("part"),
                       F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")), 256)).alias("digest"),
                       F.col(text).alias("text"))
    bits = [F.when(c, 1 << i).otherwise(0) for i, c in enumerate(failed_alone())]
    judged = measured(slim, keep=["doc_id", "part", "digest"]).select(
        "_row.*", sum(bits[1:], bits[0]).cast("int").alias("failed"))
    judged = reliable_checkpoint(judged, "audit-judged")  # one short row a document
    known = labels.groupBy(F.col(doc_id).cast("long").alias("doc_id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    # null ids have no label; a second key keeps them from meeting in one task
    salt = F.when(F.col("doc_id").isNull(), F.crc32("digest") % 1024 + 1).otherwise(0)
    judged = judged.withColumn("salt", salt).join(known.withColumn("salt", F.lit(0).cast("long")), ["doc_id", "salt"],
                                                  "left").drop("salt")
    groups = ["part", "failed", F.coalesce("good", F.lit(False)).cast("long").alias("good"),
              F.coalesce("toxic", F.lit(False)).cast("long").alias("toxic")]
    every = judged.groupBy(*groups, F.col("doc_id").isNull().alias("unnamed")).agg(F.count("*").alias("n"))
    smallest = judged.where("doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
    holders = judged.join(smallest, ["digest", "doc_id"], "left_semi").groupBy(*groups).agg(F.count("*").alias("n"))
    # all but the holders of the smallest id and the unnamed are copies: they also fail the last filter
    copy = 1 << len(bits)
    cells = every.select("part", F.when(F.col("unnamed"), F.col("failed")).otherwise(F.col("failed") + copy).alias("failed"),
                         "good", "toxic", "n")
    cells = cells.unionByName(holders).unionByName(
        holders.withColumns({"failed": F.col("failed") + copy, "n": -F.col("n")}))
    return cells.groupBy("part", "failed").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"),
        F.sum(F.col("n") * F.col("toxic")).alias("toxic")).where("n > 0")


def order_steps(filters: str = FILTERS) -> list[dict]:
    """Every step of every order: the filter's bit and the bits of those before it."""
    steps = []
    for order in permutations(filters):
        before = 0
        for i, f in enumerate(order, start=1):
            bit = 1 << filters.index(f)
            steps.append({"filter_order": "".join(order), "step": i, "bit": bit, "before": before})
            before |= bit
    return steps


def replay(counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """A row per part, order and step from (part, failed, n, good, toxic), at most 32 rows a part."""
    steps = F.from_json(F.lit(json.dumps(order_steps(filters))),
                        "array<struct<filter_order:string,step:int,bit:int,before:int>>")
    each = counts.select("*", F.explode(steps).alias("s")).select("part", "failed", "n", "good", "toxic", "s.*")
    fails = F.col("failed").bitwiseAND(F.col("bit")) != 0
    gone = F.col("failed").bitwiseAND(F.col("before")) != 0

    def count(cond, of="n"):
        return F.sum(F.when(cond, F.col(of)).otherwise(0))

    out = each.groupBy("part", "filter_order", "step", "bit").agg(
        count(~fails & ~gone).alias("kept"), count(fails & ~gone).alias("removed"),
        count(fails & gone).alias("redundant"), count(F.col("failed") == F.col("bit")).alias("unique_fails"),
        count(fails & ~gone, "good").alias("good_lost"), count(fails & ~gone, "toxic").alias("toxic_lost"))
    total = out.groupBy("part", "bit").agg(F.sum("removed").alias("shapley"))
    return out.join(total, ["part", "bit"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost",
        "shapley")


def op13_filter_interaction_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replay(failure_counts(C.table(spark, sf_dir, "documents"), C.table(spark, sf_dir, "labels")))
