"""Operator 11, exact top-k inner product search by norm-bucketed retrieval.

Vectors are grouped by length.  A query needs at least its k-th best score so far; divided by its own
length and by the greatest length of a bucket, this is the cosine that a vector of the bucket must reach
(the local threshold).  A bucket whose local threshold is above 1 is skipped whole.  In the others the
local threshold chooses how candidates are found: a low one keeps the vectors that are long enough
(length pruning), a high one keeps those whose unit components lie, in the query's largest coordinates,
in the range that the threshold allows (coordinate pruning, over sorted lists of the bucket's unit
components).  Each bucket finds on a few of its queries from which threshold on the ranges are short
enough.  What remains is verified by exact integer products.  Ranges are widened by more than
the rounding error, so pruning loses nothing: the result is exact.

On Spark: vectors are dealt to groups of bounded size by length (equal lengths are divided by row), queries
to groups by the length that they need.  A first, bounded set of the longest vectors gives every query a
first threshold.  A pair of groups is searched by one task unless the greatest length in the one is less
than any query of the other needs; a task returns at most k rows a query, and a grouped ranking merges
them.  So a row moves once for each group of the other side that it may meet, never once per row.

Defined cases: vectors that are null or hold null or non-finite components take no part; an empty vector
takes part with score 0, a shorter one as if filled up with zeros; a row is itself only, so another row
of the same id is a candidate like any other; a null id is no query by an id's condition, and
comes after all others among ties; fewer than k candidates are returned all; scores beyond a long count
as the nearest long; an empty table gives an empty result; other columns
are ignored, whatever they are called.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ridegrid.llm import common as C
from ridegrid.llm import vectors as V
from ridegrid.session import reliable_checkpoint

#: Rows of a group at most and at least, length classes, vectors that give the first thresholds.
GROUP_ROWS, LEAST_ROWS, CLASSES, SEED_ROWS = 65536, 1024, 256, 2048
#: Vectors of a bucket, the length of its shortest vector against the longest.
BUCKET_ROWS, BUCKET_RATIO = 2048, 0.9
#: Coordinates looked at; share of a bucket in the shortest range from which coordinates are worth it.
FOCUS, SHARE, TUNED_ON = 3, 0.25, 16
#: More than the relative error of the lengths, cosines and ranges.
SLACK = 1e-9
LONG = (1 << 63) - 1


class Bucket:
    """Vectors of similar length in the order of their ids, with sorted lists of their unit components."""

    def __init__(self, x: np.ndarray, length: np.ndarray):
        self.x, self.length, self.longest = x, length, float(length.max())
        self.unit = x / np.where(length > 0, length, 1)[:, None]
        self._lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def sorted_list(self, f: int) -> tuple[np.ndarray, np.ndarray]:
        if f not in self._lists:
            order = np.argsort(self.unit[:, f])
            self._lists[f] = order, self.unit[order, f]
        return self._lists[f]

    def ranges(self, unit: np.ndarray, threshold: float) -> list[tuple[int, int, int]]:
        """Of the unit query's largest coordinates: (coordinate, from, to) in the sorted list, where a vector of
        at least this cosine can lie."""
        out = []
        for f in np.argsort(-np.abs(unit), kind="stable")[:FOCUS].tolist():
            q = float(unit[f])
            half = np.sqrt(max(0.0, 1 - threshold * threshold) * max(0.0, 1 - q * q)) + 1e-6
            _, values = self.sorted_list(f)
            # within reach of q: beyond these, the rest of the vector cannot make up the cosine
            low = -1.0 if q <= -threshold else q * threshold - half
            high = 1.0 if q >= threshold else q * threshold + half
            a, b = np.searchsorted(values, [low - 1e-6, high + 1e-6])
            out.append((f, int(a), int(b)))
        return out

    def by_coordinates(self, unit: np.ndarray, threshold: float) -> np.ndarray:
        """The places of the vectors that lie in the range of every coordinate looked at."""
        spans = self.ranges(unit, threshold)
        hits = np.zeros(len(self.x), np.int8)
        for f, a, b in spans:
            hits[self.sorted_list(f)[0][a:b]] += 1
        return np.flatnonzero(hits == len(spans))

    def by_length(self, least: float) -> np.ndarray:
        return np.flatnonzero(self.length >= least)

    def turning_point(self, units: np.ndarray, thresholds: np.ndarray) -> float:
        """The local threshold from which on coordinates prune enough, as seen on some of the queries."""
        order = np.argsort(-thresholds, kind="stable")
        at = np.inf
        for i in order[np.linspace(0, len(order) - 1, min(TUNED_ON, len(order))).astype(int)].tolist():
            if min(b - a for _, a, b in self.ranges(units[i], thresholds[i])) > SHARE * len(self.x):
                break
            at = float(thresholds[i])
        return at


def _best(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, scores) of the k best of each row, ties to the first place; overwrites ``scores``."""
    row = np.arange(len(scores))
    places, found = [], []
    for _ in range(min(k, scores.shape[1])):
        at = scores.argmax(axis=1)
        places.append(at)
        found.append(scores[row, at])
        scores[row, at] = -np.inf
    return np.stack(places, axis=1), np.stack(found, axis=1)


class Search:
    """The k best of a set of queries, bucket by bucket."""

    def __init__(self, x: np.ndarray, row: np.ndarray, floor: np.ndarray, k: int):
        self.x, self.row, self.floor, self.k = x, row, floor, k
        wide = x.astype(np.float64)
        self.length = np.sqrt(np.einsum("ij,ij->i", wide, wide))
        self.unit = wide / np.where(self.length > 0, self.length, 1)[:, None]
        self.score = np.full((len(x), k), -np.inf)
        self.place = np.full((len(x), k), LONG)  # the candidate's place in the order of ids
        self.pruned = {"bucket": 0, "length": 0, "coordinates": 0}

    def need(self) -> np.ndarray:
        """The score that a candidate must reach, a little less for rounding."""
        last = self.score[:, -1].astype(np.float64)
        need = np.maximum(self.floor, last)
        return need - SLACK * np.abs(np.where(np.isfinite(need), need, 0))

    def _offer(self, queries: np.ndarray, score: np.ndarray, place: np.ndarray):
        """Merge better candidates into the best of some queries; ties go to the smaller place."""
        if score.dtype == object and self.score.dtype != object:
            self.score = self.score.astype(object)
        s = np.concatenate((self.score[queries], score), axis=1)
        p = np.concatenate((self.place[queries], place), axis=1)
        p[s == -np.inf] = LONG
        if s.dtype == object:
            keep = np.array([sorted(range(s.shape[1]), key=lambda j: (-s[i, j], p[i, j]))[:self.k] for i in range(len(s))])
        else:
            keep = np.lexsort((p, -s), axis=-1)[:, :self.k]
        self.score[queries] = np.take_along_axis(s, keep, 1)
        self.place[queries] = np.take_along_axis(p, keep, 1)

    def _verify(self, queries: np.ndarray, bucket: Bucket, at: np.ndarray, place: np.ndarray, row: np.ndarray):
        if not len(queries) or not len(at):
            return
        s = V.products(self.x[queries], bucket.x[at])
        if s.dtype == object:
            s = np.minimum(np.maximum(s, -LONG - 1), LONG)
        own = self.row[queries][:, None] == row[at][None, :]
        s[own] = -np.inf
        reach = np.asarray(s >= self.need()[queries][:, None], dtype=bool).any(axis=1)
        if reach.any():
            places, found = _best(s[reach], self.k)
            self._offer(queries[reach], found, place[at][places])

    def look(self, bucket: Bucket, place: np.ndarray, row: np.ndarray):
        """Search a bucket; ``place`` and ``row``: its vectors' places in the order of ids, and rows."""
        need = self.need()
        with np.errstate(divide="ignore", invalid="ignore"):
            local = np.where((need > 0) & (self.length > 0), need / (self.length * bucket.longest), -np.inf)
            least = np.where((need > 0) & (self.length > 0), need / self.length, -np.inf)
        live = ~(local > 1 + SLACK)
        self.pruned["bucket"] += int((~live).sum())
        turn = np.inf
        if (high := np.flatnonzero(live & (local > 0))).size:
            turn = bucket.turning_point(self.unit[high], local[high])
        for q in np.flatnonzero(live & (local >= turn)):
            at = bucket.by_coordinates(self.unit[q], min(1.0, float(local[q])))
            self.pruned["coordinates"] += len(place) - len(at)
            self._verify(np.array([q]), bucket, at, place, row)
        queries = np.flatnonzero(live & ~(local >= turn))
        if len(queries):
            at = bucket.by_length(least[queries].min() * (1 - SLACK))
            self.pruned["length"] += (len(place) - len(at)) * len(queries)
            self._verify(queries, bucket, at, place, row)


def buckets(x: np.ndarray, length: np.ndarray) -> list[np.ndarray]:
    """Places of the vectors by buckets, longest first, each in the given order."""
    order = np.argsort(-length, kind="stable")
    out, a = [], 0
    while a < len(order):
        shorter = np.flatnonzero(length[order[a:a + BUCKET_ROWS]] < BUCKET_RATIO * length[order[a]])
        b = a + (int(shorter[0]) if len(shorter) else min(BUCKET_ROWS, len(order) - a))
        out.append(np.sort(order[a:b]))
        a = b
    return out


FOUND = pa.schema([("q", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def _search(k: int):
    def run(queries: pa.Table, vectors: pa.Table) -> pa.Table:
        if not queries.num_rows or not vectors.num_rows:
            return FOUND.empty_table()
        order = pc.sort_indices(vectors, [("id", "ascending"), ("row", "ascending")], null_placement="at_end")
        vectors = vectors.take(order)  # places are in the order of ids, nulls last
        q, x = V.matrix(queries.column("x")), V.matrix(vectors.column("x"))
        width = max(q.shape[1], x.shape[1])
        q, x = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (q, x))
        row, length = (vectors.column(c).to_numpy() for c in ("row", "length"))
        search = Search(q, queries.column("row").to_numpy(), queries.column("floor").to_numpy(), k)
        for at in buckets(x, length):
            search.look(Bucket(x[at], length[at]), at, row[at])
        i, j = np.nonzero(search.score != -np.inf)
        score = [int(s) for s in search.score[i, j]]
        return pa.table([queries.column("row").take(pa.array(i)), queries.column("id").take(pa.array(i)),
                         vectors.column("id").take(pa.array(search.place[i, j])), pa.array(score, pa.int64())],
                        schema=FOUND)

    return run


def _floors(seed: np.ndarray, seed_rows: np.ndarray, k: int):
    """Adds to queries ``floor``, a score that their k-th best reaches at least, and ``least``, the length that
    a vector needs for it."""
    def run(batches):
        for batch in batches:
            x = V.matrix(batch.column("x"))
            width = max(x.shape[1], seed.shape[1])
            s = np.pad(x, ((0, 0), (0, width - x.shape[1]))).astype(float) @ np.pad(
                seed, ((0, 0), (0, width - seed.shape[1]))).astype(float).T
            length = batch.column("length").to_numpy()
            s -= SLACK * np.abs(s).max(axis=1, initial=0)[:, None]
            s[batch.column("row").to_numpy()[:, None] == seed_rows[None, :]] = -np.inf
            floor = np.partition(s, -k, axis=1)[:, -k] if s.shape[1] >= k else np.full(len(s), -np.inf)
            floor = np.minimum(floor, float(LONG))
            with np.errstate(divide="ignore", invalid="ignore"):
                least = np.where((floor > 0) & (length > 0), floor / length * (1 - SLACK), 0.0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(floor), pa.array(least)],
                                             names=[*batch.schema.names, "floor", "least"])

    return run


def _dealt(df: DataFrame, by: str, rows: int, group_rows: int) -> tuple[DataFrame, DataFrame]:
    """(``df`` with its ``grp``: similar values of ``by``, about ``group_rows`` rows at most; a row per group with
    the smallest and greatest value)."""
    classes = max(1, min(CLASSES, rows // group_rows))
    edges = df.agg(F.percentile_approx(by, [i / classes for i in range(1, classes)], 10000)).first()[0] if classes > 1 else []
    edges = sorted(set(edges))
    place = F.size(F.filter(F.array(*[F.lit(float(e)) for e in edges]), lambda e: e <= F.col(by))) if edges else F.lit(0)
    ranked = df.withColumn("cls", place)
    sizes = {r["cls"]: r["count"] for r in ranked.groupBy("cls").count().collect()}  # CLASSES rows at most
    parts = [1 + sizes.get(c, 0) // group_rows for c in range(len(edges) + 1)]
    firsts = np.concatenate(([0], np.cumsum(parts))).tolist()
    own = F.pmod(F.xxhash64("row"), F.element_at(F.array(*[F.lit(p).cast("long") for p in parts]), F.col("cls") + 1))
    first = F.element_at(F.array(*[F.lit(f).cast("long") for f in firsts[:-1]]), F.col("cls") + 1)
    dealt = ranked.withColumn("grp", (first + own).cast("int")).drop("cls")
    return dealt, dealt.groupBy("grp").agg(F.min(by).alias("lowest"), F.max(by).alias("greatest"))


def exact_top_k(vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256, vec_id: str = "vec_id",
                vector: str = "embedding", group_rows: int = GROUP_ROWS) -> DataFrame:
    """query_id, rank, vec_id and score of the k best rows of every row that ``is_query``."""
    whole, x = V.floored(vectors, scale, vector)
    base = vectors.where(whole).select(
        F.col(vec_id).cast("long").alias("id"), x.alias("x"), F.coalesce(is_query, F.lit(False)).alias("asks"),
        F.monotonically_increasing_id().alias("row"))
    base = base.withColumn("length", F.sqrt(F.aggregate("x", F.lit(0.0), lambda s, v: s + v.cast("double") * v)))
    base = reliable_checkpoint(base, "vectors")  # written once: a row keeps its number
    rows, asking = base.agg(F.count("*"), F.count_if("asks")).first()
    spark = vectors.sparkSession
    schema = "query_id long, rank int, vec_id long, score long"
    if not asking:
        return spark.createDataFrame([], schema)
    # groups small enough to keep all cores busy, but never tiny ones
    tasks = 4 * spark.sparkContext.defaultParallelism
    size = min(group_rows, max(LEAST_ROWS, rows // tasks))
    longest = base.orderBy(F.desc("length"), "row").select("x", "row").limit(SEED_ROWS).toArrow()  # bounded
    seed, seed_rows = V.matrix(longest.column("x")), longest.column("row").to_numpy()
    queries = base.where("asks").select("id", "row", "x", "length")
    queries = C.map_arrow(queries, _floors(seed, seed_rows, k), "id long, row long, x array<bigint>, length double, "
                                                                "floor double, least double")
    queries = reliable_checkpoint(queries, "vector-queries")
    queries, asked = _dealt(queries, "least", asking, group_rows)
    dealt, lengths = _dealt(base.select("id", "row", "x", "length"), "length", rows, size)
    # which groups of queries a group of vectors may serve; groups of queries are few: a row per GROUP_ROWS queries
    asked = asked.withColumnRenamed("grp", "qg").select("qg", "lowest")
    needs = F.array(*[F.struct(F.lit(r["qg"]).alias("qg"), F.lit(r["lowest"]).alias("least")) for r in asked.collect()])
    cells = lengths.select(F.col("grp").alias("cg"), F.explode(F.filter(
        needs, lambda n: n["least"] <= F.col("greatest") * (1 + SLACK))).alias("n")).select("cg", "n.qg")
    cells = reliable_checkpoint(cells, "vector-cells")
    served = dealt.withColumnRenamed("grp", "cg").join(cells, "cg")
    asking_ = queries.withColumnRenamed("grp", "qg").join(cells, "qg")
    C.importable(spark)
    found = asking_.groupBy("qg", "cg").cogroup(served.groupBy("qg", "cg")).applyInArrow(
        _search(k), "q long, query_id long, vec_id long, score long")
    place = Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def op11_exact_top_k_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_top_k(C.table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)
