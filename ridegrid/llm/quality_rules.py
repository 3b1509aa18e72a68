"""Operator 10, quality rules: repetition measured on a suffix array.

The words of a slice of documents are sorted as suffixes by prefix doubling (a suffix ends with
its document, so documents never mix).  Neighbours in that order with a common prefix of at least
``min_repeat`` words are the longest-common-prefix intervals; each suffix's longest repeat is the
longer of its two neighbours' prefixes.  The union of these spans gives the share of words that
lies in repeated passages, and the largest the longest repeat.  Both are limited.

Defined cases: a null or empty text has no words and fails the word minimum; repeated rows and
repeated or null ids are judged row by row; other columns come back untouched; an empty table
gives an empty result.
"""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridegrid.llm import common as C

#: Text in one slice.  The arrays of a slice take some thirty times its bytes.
SLICE_BYTES = 1 << 20

MEASURES = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
            "n_covered long, longest_repeat long")


@dataclass(frozen=True)
class Rules:
    """``min_words`` and ``max_window_percent`` are the base rules; the rest judge the suffix array."""

    min_words: int = 20
    window: int = 8
    max_window_percent: int = 30
    min_repeat: int = 13
    max_cover_percent: int = 25
    max_longest: int = 400


def suffix_order(key: np.ndarray, ends: np.ndarray):
    """Prefix doubling.  ``key``: first symbol of each suffix; ``ends``: where its text ends.

    Returns (order, ranks at depth 1, 2, 4, ...).  Only groups that are still tied are sorted again.
    """
    n = len(key)
    order = np.argsort(key, kind="stable")
    ranks = []
    act, sorted_key, k = np.arange(n), key[order], 1
    rank = np.zeros(n, dtype=np.int64)
    while True:
        head = np.ones(len(act), dtype=bool)
        head[1:] = sorted_key[1:] != sorted_key[:-1]
        last = np.ones(len(act), dtype=bool)
        last[:-1] = head[1:]
        rank[order[act]] = act[np.maximum.accumulate(np.where(head, np.arange(len(act)), 0))]
        ranks.append(rank.copy())
        act = act[~(head & last)]
        if not act.size:
            return order, ranks
        suffix = order[act]
        nxt = suffix + k
        second = np.where(nxt < ends[suffix], rank[np.minimum(nxt, n - 1)] + 1, 0)
        both = rank[suffix] * (n + 1) + second
        by = np.argsort(both, kind="stable")
        order[act], sorted_key = suffix[by], both[by]
        k *= 2


def common_prefix(a: np.ndarray, b: np.ndarray, ends: np.ndarray, ranks: list[np.ndarray]) -> np.ndarray:
    """Words that the suffixes at ``a`` and ``b`` share from their starts, by the doubling ranks."""
    a, b, n = a.copy(), b.copy(), len(ends)
    length = np.zeros(len(a), dtype=np.int64)
    stop_a, stop_b = ends[a], ends[b]
    for level in range(len(ranks) - 1, -1, -1):
        inside = (a < stop_a) & (b < stop_b)
        same = inside & (ranks[level][np.minimum(a, n - 1)] == ranks[level][np.minimum(b, n - 1)])
        step = same.astype(np.int64) << level
        a += step
        b += step
        length += step
    return length


def repeats(codes: np.ndarray, offsets: np.ndarray, window: int, min_repeat: int):
    """Per word: in a ``window``-word run found twice; in a repeat of ``min_repeat``; its length."""
    n = len(codes)
    if not n:
        return np.zeros(0, bool), np.zeros(0, bool), np.zeros(0, np.int64)
    counts = np.diff(offsets)
    doc = np.repeat(np.arange(len(counts)), counts)
    ends = np.repeat(offsets[1:], counts)
    order, ranks = suffix_order(doc * (int(codes.max()) + 1) + codes, ends)
    left, right = order[:-1], order[1:]
    longest = np.zeros(n, dtype=np.int64)
    level = min(window, min_repeat).bit_length() - 1  # shorter repeats are not asked for
    if level >= len(ranks):
        return np.zeros(n, bool), np.zeros(n, bool), longest
    near = np.flatnonzero(ranks[level][left] == ranks[level][right])
    shared = common_prefix(left[near], right[near], ends, ranks)
    np.maximum.at(longest, left[near], shared)
    np.maximum.at(longest, right[near], shared)
    again = np.flatnonzero(longest >= window)
    far = np.flatnonzero(longest >= min_repeat)
    return C.cover(again, window, n), C.cover(far, longest[far], n), longest


def per_text(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, dtype=np.int64)
    np.cumsum(values, out=total[1:])
    return np.diff(total[offsets])


def duplicate_lines(text: str) -> int:
    """Lines with a word that equal an earlier line of the text."""
    seen: set[str] = set()
    again = 0
    for line in text.split("\n"):
        if line.strip(" \t\n\x0b\x0c\r"):
            again += line in seen
            seen.add(line)
    return again


def _measure(rules: Rules, at: int | None = None):
    kinds = [pa.int64()] * 7
    names = [x.split()[0] for x in MEASURES.split(", ")]

    def run(batches):
        for batch in C.text_slices(C.with_text(batches, at), "_text", SLICE_BYTES):
            texts = batch.column("_text")
            w = C.words_of(texts, lower=False)
            again, covered, longest = repeats(w.codes, w.offsets, rules.window, rules.min_repeat)
            data = w.data
            word_start = C.NOT_SPACE[data] & ((data & 0xC0) != 0x80)
            n = w.counts
            top = np.zeros(len(n), dtype=np.int64)
            if w.n:
                full = np.flatnonzero(n)
                top[full] = np.maximum.reduceat(longest, w.offsets[:-1][full])
            plain = [t or "" for t in texts.to_pylist()]
            columns = [
                n, per_text(word_start, w.text_offsets),
                [sum(map(t.count, "#*$%&|<>")) for t in plain], [duplicate_lines(t) for t in plain],
                per_text(again, w.offsets),
                per_text(covered, w.offsets), top,
            ]
            own = [pa.array(c, type=k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("_row"), *own], names=["_row", *names])

    return run


def judge(docs: DataFrame, text: str = "text", rules: Rules = Rules(), keep=None) -> DataFrame:
    """Every row of ``docs`` (struct ``_row``, of the columns in ``keep``, all by default) with its
    measures, ``base_failed`` and ``kept``."""
    df, row, at = C.carried_once(docs, text, keep)
    out = C.map_arrow(df, _measure(rules, at), f"_row {row}, {MEASURES}")
    failed = (F.col("n_words") < rules.min_words) | (
        100 * F.col("n_repeat_words") > rules.max_window_percent * F.col("n_words"))
    return out.withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & (100 * F.col("n_covered") <= rules.max_cover_percent * F.col("n_words"))
        & (F.col("longest_repeat") <= rules.max_longest))


def filter_documents(docs: DataFrame, text: str = "text", rules: Rules = Rules()) -> DataFrame:
    """The rows of ``docs`` that the rules keep, unchanged."""
    return judge(docs, text, rules).where("kept").select("_row.*")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.table(spark, sf_dir, "documents")
    return judge(docs, keep=["doc_id"]).select(F.col("_row.doc_id").alias("doc_id"), "n_words", "word_chars", "n_symbols",
                              "n_dup_lines", "n_repeat_words", "base_failed", "kept",
                              "n_covered")
