"""Operator 6, sharding by a histogram sort (DataFrame functions only).

Rows are ordered by one key and cut into shards of nearly equal bytes.  The cutting keys
(splitters) are found without sorting: each round proposes probes between the known bounds of
every splitter, one distributed aggregate counts the exact bytes in each probe interval, and the
bounds close in, until the bytes below a splitter are within the tolerance of its target or at
most one row lies between its bounds.  Then rows move once, to their splitter range.

Ranges are finer than shards (``ranges_per_shard``), so that no task holds a whole shard; a row's
slot is the number of rows in earlier ranges of its shard plus its place in its own range.

The key is (id, tie), tie being a number of the row itself; so rows that share an id, even a third of
the table, are still divided.  Defined cases: a null id sorts first; a null text has size 1; ties
and repeated rows are divided like others; empty table: empty result; other columns are ignored
unless asked for in ``keep``.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ridegrid.llm import common as C
from ridegrid.session import reliable_checkpoint

LOWEST = -(1 << 63)
#: Probes inside the one first interval, and inside each splitter's interval afterwards.
FIRST_PROBES, PROBES = 4096, 64

Key = tuple[int, int]  # (id, tie), in the order of rows


def _lit(x: int) -> str:
    return f"({x + 1}L - 1L)" if x == LOWEST else f"{x}L"


def _place_among(bounds: list[Key]) -> str:
    """SQL for the number of ``bounds`` (sorted) at or below a row's key, by halving."""
    def part(lo: int, hi: int) -> str:
        if lo == hi:
            return str(lo)
        mid = (lo + hi) // 2
        k, tie = bounds[mid]
        above = f"_k > {_lit(k)} or (_k = {_lit(k)} and _tie >= {_lit(tie)})"
        return f"case when {above} then {part(mid + 1, hi)} else {part(lo, mid)} end"

    return part(0, len(bounds))


def _step(lo: Key, hi: Key, probes: int) -> tuple[bool, int, int]:
    """(whether the interval divides ties of one id, its first coordinate, the probes' distance)."""
    by_tie = hi[0] == lo[0] or hi == (lo[0] + 1, 0)
    first, end = (lo[1], hi[1] if hi[0] == lo[0] else 1 << 62) if by_tie else (lo[0], hi[0] + (hi[1] > 0))
    return by_tie, first, max(1, -(-(end - first) // probes))


def _count(rows: DataFrame, spans: list[tuple[Key, Key]], probes: int) -> dict[int, list[tuple[Key, Key, int, int]]]:
    """Of each span, sorted and apart from each other: the weight and rows between neighbouring probes
    (from, to, weight, rows), where there are any."""
    edges = [x for span in spans for x in span]  # place 2i + 1 is inside span i
    steps = [_step(lo, hi, probes) for lo, hi in spans]
    inside = rows.withColumn("_at", F.expr(_place_among(edges))).where("_at % 2 = 1").withColumn(
        "_i", F.expr("cast((_at - 1) / 2 as int)"))
    flag, first, step = (f"array({', '.join(x)})[_i]" for x in (
        [str(t).lower() for t, _, _ in steps], [_lit(f) for _, f, _ in steps], [_lit(d) for _, _, d in steps]))
    wide = any(hi[0] - lo[0] >= 1 << 62 for lo, hi in spans)  # a difference beyond a long
    sub = f"({'cast(' * wide}case when {flag} then _tie else _k end{' as decimal(20, 0))' * wide} - {first}) div {step}"
    got = inside.groupBy("_i", F.expr(sub).alias("_sub")).agg(F.sum("_w").alias("w"), F.count("*").alias("n")).collect()
    out: dict[int, list[tuple[Key, Key, int, int]]] = {i: [] for i in range(len(spans))}
    for r in sorted(got, key=lambda r: (r["_i"], r["_sub"])):  # at most ``probes`` rows per span
        by_tie, start, wide = steps[r["_i"]]
        x = start + r["_sub"] * wide
        lo, hi = spans[r["_i"]]
        key, end = ((lo[0], x), (lo[0], x + wide)) if by_tie else ((x, 0), (x + wide, 0))
        out[r["_i"]].append((max(key, lo), min(end, hi), r["w"], r["n"]))
    return out


def find_splitters(rows: DataFrame, parts: int, tolerance: float) -> list[Key]:
    """``parts - 1`` keys with nearly equal ``_w`` between them.  ``rows``: _k, _tie, _w."""
    lo_k, hi_k, total, count = rows.agg(F.min("_k"), F.max("_k"), F.sum("_w"), F.count("*")).first()
    if not total:
        return []
    goals = [total * (i + 1) / parts for i in range(parts - 1)]
    slack = tolerance * total / parts
    # of each splitter: (key, weight below it, rows below it) of a lower and of an upper bound
    state = [(((lo_k, 0), 0, 0), ((hi_k + 1, 0), total, count)) for _ in goals]
    done: list[Key | None] = [None] * len(goals)
    probes = FIRST_PROBES
    while None in done:
        spans = sorted({(lo[0], hi[0]) for (lo, hi), key in zip(state, done, strict=True) if key is None})
        cells = _count(rows, spans, probes)
        probes = PROBES
        for i, goal in enumerate(goals):
            if done[i] is not None:
                continue
            low, high = state[i]
            weight, n = low[1:]
            found = []
            for key, end, w, c in cells[spans.index((low[0], high[0]))]:
                found.append((key, weight, n))
                weight, n = weight + w, n + c
                found.append((end, weight, n))
            low = max([low, *(x for x in found if x[1] <= goal)])
            high = min([high, *(x for x in found if x[1] > goal)])
            state[i] = (low, high)
            near = min(low, high, key=lambda x: abs(goal - x[1]))
            if abs(goal - near[1]) <= slack or high[2] - low[2] <= 1 or low[0] >= high[0]:
                done[i] = near[0]
    return sorted(done)


def histogram_shards(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text",
                     tolerance: float = 0.001, ranges_per_shard: int = 8,
                     keep: tuple[str, ...] = ()) -> DataFrame:
    """``_k``'s column, size, text_crc32, shard and slot of every row, and the columns in ``keep``."""
    if docs.isEmpty():
        return docs.select(F.col(key), *[F.col(c) for c in keep], F.lit(1).cast("long").alias("size"),
                           F.crc32(F.lit("")).alias("text_crc32"), F.lit(0).alias("shard"),
                           F.lit(0).cast("long").alias("slot"))
    body = F.coalesce(F.col(text), F.lit(""))
    light = docs.select(
        F.col(key).alias("_id"), *[F.col(c).alias(f"_keep{i}") for i, c in enumerate(keep)],
        (F.octet_length(body) + 1).cast("long").alias("_w"), F.crc32(body.cast("binary")).alias("_crc"),
        F.col(key).cast("long").alias("_k"),
        F.monotonically_increasing_id().alias("_tie"))
    # written once: the tie is fixed, and the counting rounds read no texts
    light = reliable_checkpoint(light, "shard-rows")
    smallest = light.agg(F.min("_k")).first()[0]
    before = 0 if smallest is None else max(smallest - 1, LOWEST)  # a null id sorts before the smallest
    light = light.withColumn("_k", F.coalesce("_k", F.lit(before).cast("long")))
    parts = shards * ranges_per_shard
    splitters = find_splitters(light, parts, tolerance)
    ranged = light.withColumn("_range", F.expr(_place_among(splitters)))
    sizes = {r["_range"]: r["n"] for r in ranged.groupBy("_range").agg(F.count("*").alias("n")).collect()}
    # splitter i starts range i + 1, and range r belongs to shard r // ranges_per_shard
    starts, seen = [], {}
    for r in range(len(splitters) + 1):
        s = min(r // ranges_per_shard, shards - 1)
        starts.append(seen.get(s, 0))
        seen[s] = seen.get(s, 0) + sizes.get(r, 0)
    first = F.expr(f"array({', '.join(_lit(x) for x in starts)})")
    place = F.row_number().over(Window.partitionBy("_range").orderBy("_k", "_tie"))  # the one exchange
    return ranged.withColumn("_place", place).select(
        F.col("_id").alias(key), *[F.col(f"_keep{i}").alias(c) for i, c in enumerate(keep)],
        F.col("_w").alias("size"), F.col("_crc").alias("text_crc32"),
        F.least(F.floor(F.col("_range") / ranges_per_shard), F.lit(shards - 1)).cast("int").alias("shard"),
        (F.element_at(first, F.col("_range") + 1) + F.col("_place") - 1).cast("long").alias("slot"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.table(spark, sf_dir, "documents").select("doc_id", "text")
    return histogram_shards(docs, 16).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
