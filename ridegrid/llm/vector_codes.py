"""Operator 12, vector code compression: k-means of vector parts with Drake-Hamerly adaptive bounds.

Every vector is cut into parts; each part position has a codebook, refined by rounds of k-means.  With
each part a row keeps its ``b`` closest entries, the assigned one first, each with a lower bound of its
distance, and one outer bound for all other entries.  When entries have moved, a bound falls by what its entry
moved, the outer bound by the longest move.  The distance to the assigned entry is computed exactly.
An entry whose bound lies above it cannot be closer or equal, so only entries with a lower bound are
compared, by exact whole-number distances (ties to the lower index); if the outer bound is not
above, all entries are compared and the closest ``b`` chosen anew.  ``b`` adapts per part position
between rounds: it doubles while many rows fall back to all entries, and shrinks to what the rows used.

On Spark: a round is one pass.  The rows with their bounds are written as a table that the next round
reads; the same pass writes, per task and entry, the count and component sums, which a grouped sum brings
together, so the driver sees one row per entry and component.  Codebooks and moves (a bounded size:
parts x entries x width) travel with the tasks.  A round's table is dropped when the next is written.

Defined cases: vectors that are null or hold null or non-finite components are dropped; a vector that is
shorter than the longest, or whose length the parts do not divide, counts as filled up with zeros;
a null id comes after all others in the first codebooks, and rows that repeat an id follow their
vectors' order; fewer rows than entries give fewer entries; null labels count as one label; distances and
sums are exact whatever the size of the components (an error beyond a long is the largest long);
an empty table gives an empty result; other columns are ignored, whatever they are called.
"""
from __future__ import annotations

import hashlib
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridegrid.llm import common as C
from ridegrid.llm import vectors as V
from ridegrid.session import reliable_checkpoint, scratch_path

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Closest entries kept at first, at least and at most; share of rows compared with all entries that doubles them.
FIRST_B, LEAST_B, MOST_B, MANY = 16, 4, 64, 0.1
#: More than the relative rounding error of a bound kept in single precision.
SLACK = 1e-6
LONG = (1 << 63) - 1
ROWS = 4096


def squares(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows to all entries: doubles, or Python numbers where these are not exact."""
    most = float(max(np.abs(x.astype(float)).max(initial=0), np.abs(book.astype(float)).max(initial=0)))
    if 4 * x.shape[1] * most * most < V.EXACT:
        a, b = x.astype(float), book.astype(float)
        return np.einsum("ij,ij->i", a, a)[:, None] + np.einsum("ij,ij->i", b, b)[None, :] - 2 * (a @ b.T)
    gap = x.astype(object)[:, None, :] - book.astype(object)[None, :, :]
    return (gap * gap).sum(axis=2)


def pair_squares(x: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Exact squared distance of each row to its own other row."""
    most = float(max(np.abs(x.astype(float)).max(initial=0), np.abs(other.astype(float)).max(initial=0)))
    kind = np.int64 if 4 * x.shape[1] * most * most < V.EXACT else object
    gap = x.astype(kind) - other.astype(kind)
    return (gap * gap).sum(axis=1)


def _root(square: np.ndarray) -> np.ndarray:
    return np.sqrt(square.astype(np.float64))


class Bounds:
    """The closest entries of one part of some rows: ``near`` (assigned first; -1: none), ``lower``, ``outer``."""

    def __init__(self, near: np.ndarray, lower: np.ndarray, outer: np.ndarray):
        self.near, self.lower, self.outer = near, lower, outer

    @classmethod
    def compared(cls, x: np.ndarray, book: np.ndarray, b: int) -> tuple[Bounds, np.ndarray]:
        """Bounds from all distances, and the exact squared distance to the closest entry."""
        d = squares(x, book)
        row, best = np.arange(len(x)), np.asarray(d.argmin(axis=1))  # the first of equal ones
        own = d[row, best].copy()
        d = d.astype(np.float64)
        d[row, best] = -1  # first in any case
        b = min(b, len(book))
        near = np.argpartition(d, min(b, len(book) - 1), axis=1)[:, :b]
        found = np.take_along_axis(d, near, 1)
        if b < len(book):
            outer = _root(np.partition(d, b, axis=1)[:, b]) * (1 - SLACK)
        else:
            outer = np.full(len(x), np.inf)
        order = np.argsort(found, axis=1, kind="stable")
        near, found = np.take_along_axis(near, order, 1), np.take_along_axis(found, order, 1)
        found[:, 0] = own
        return cls(near, _root(found) * (1 - SLACK), outer), own

    def resize(self, b: int) -> Bounds:
        have = self.near.shape[1]
        if b < have:  # the entries given up fall under the outer bound
            outer = np.minimum(self.outer, np.where(self.near[:, b:] < 0, np.inf, self.lower[:, b:]).min(axis=1))
            return Bounds(self.near[:, :b], self.lower[:, :b], outer)
        pad = ((0, 0), (0, b - have))
        return Bounds(np.pad(self.near, pad, constant_values=-1), np.pad(self.lower, pad, constant_values=np.inf), self.outer)

    def moved(self, x: np.ndarray, book: np.ndarray, moves: np.ndarray, b: int) -> tuple[Bounds, np.ndarray, np.ndarray]:
        """After entries moved by ``moves``: the bounds with ``b`` entries, the exact squared distance to the closest
        entry, and the number of bounds that each row used (-1: compared with all entries)."""
        lower = np.where(self.near < 0, np.inf, self.lower - moves[self.near])
        near, outer = self.near.copy(), self.outer - moves.max(initial=0)
        own = pair_squares(x, book[near[:, 0]])
        reach = _root(own) * (1 + SLACK)
        lower[:, 0] = _root(own) * (1 - SLACK)
        unsure = lower <= reach[:, None]
        unsure[:, 0] = False
        every = outer <= reach
        used = np.where(every, -1, unsure.sum(axis=1))
        some = np.flatnonzero(~every & unsure.any(axis=1))
        closest = np.zeros(len(x), dtype=np.int64)  # where the assigned entry is now
        if len(some):
            r, c = np.nonzero(unsure[some])
            exact = pair_squares(x[some[r]], book[near[some[r], c]])
            rank = near[some[r], c]
            # of each row, the smallest distance, then the lowest index; the assigned entry takes part
            rows = np.concatenate((r, np.arange(len(some))))
            dist = np.concatenate((exact, own[some]))
            entry = np.concatenate((rank, near[some, 0]))
            order = np.lexsort((entry, dist, rows)) if dist.dtype != object else np.array(
                sorted(range(len(rows)), key=lambda i: (rows[i], dist[i], entry[i])))
            head = order[np.searchsorted(rows[order], np.arange(len(some)))]
            lower[some[r], c] = _root(exact) * (1 - SLACK)
            own[some] = dist[head]
            closest[some] = (near[some] == entry[head][:, None]).argmax(axis=1)
        key = lower.copy()
        key[np.arange(len(x)), closest] = -np.inf
        turn = np.argsort(key, axis=1, kind="stable")
        near, lower = np.take_along_axis(near, turn, 1), np.take_along_axis(lower, turn, 1)
        out = Bounds(near, lower, outer).resize(min(b, len(book)))
        full = np.flatnonzero(every)
        if len(full):
            fresh, exact = Bounds.compared(x[full], book, out.near.shape[1])
            out.near[full], out.lower[full], out.outer[full] = fresh.near, fresh.lower, fresh.outer
            own[full] = exact
        return out, own, used


def move_lengths(old: np.ndarray, new: np.ndarray) -> np.ndarray:
    return _root(pair_squares(new, old)) * (1 + SLACK)


def adapted(b: int, used: dict[int, int]) -> int:
    """The next ``b`` from (bounds used: rows; -1: compared with all entries)."""
    rows = sum(used.values())
    if not rows:
        return b
    if used.get(-1, 0) > MANY * rows:
        return min(2 * b, MOST_B)
    within, seen = rows - used.get(-1, 0), 0
    for z in sorted(z for z in used if z >= 0):
        seen += used[z]
        if 100 * seen >= 99 * within:
            return max(LEAST_B, min(b, z + 2))
    return b


STATE = "_row {row}, x array<bigint>, near array<smallint>, bound array<float>"
TALLY = "part int, entry int, used int, n long, sums array<decimal(38,0)>"


def _cut(batch: pa.RecordBatch, width: int, parts: int) -> tuple[np.ndarray, list[np.ndarray]]:
    x = V.matrix(batch.column("x"), width)
    return x, np.split(x, parts, axis=1)


def _read_bounds(batch: pa.RecordBatch, widths: list[int]) -> list[Bounds]:
    near = V.matrix(batch.column("near"), sum(widths)).astype(np.int64)
    bound = V.matrix(batch.column("bound"), sum(widths) + len(widths)).astype(np.float64)
    out, at = [], 0
    for p, b in enumerate(widths):
        out.append(Bounds(near[:, at:at + b], bound[:, at + p:at + p + b], bound[:, at + p + b]))
        at += b
    return out


def _down(bound: np.ndarray) -> np.ndarray:
    """In single precision, never above."""
    return (bound - np.abs(np.where(np.isfinite(bound), bound, 0)) * SLACK).astype(np.float32)


def _round(books: list[np.ndarray], moves: list[np.ndarray] | None, widths: list[int], following: list[int]):
    """One assignment pass: rows with their bounds, then the task's counts and sums by entry."""
    parts, wide = len(books), books[0].shape[1]

    def run(batches):
        sums = [np.zeros((len(b), wide), dtype=object) for b in books]
        counts = [np.zeros(len(b), dtype=np.int64) for b in books]
        uses: list[dict[int, int]] = [{} for _ in books]
        kind = None
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                kind = kind or batch.schema.field("_row").type
                x, cut = _cut(batch, parts * wide, parts)
                states = _read_bounds(batch, widths) if moves else [None] * parts
                near, bound = [], []
                for p in range(parts):
                    if moves:
                        state, _, used = states[p].moved(cut[p], books[p], moves[p], following[p])
                        for z, n in zip(*np.unique(used, return_counts=True), strict=True):
                            uses[p][int(z)] = uses[p].get(int(z), 0) + int(n)
                    else:
                        state, _ = Bounds.compared(cut[p], books[p], following[p])
                    own = state.near[:, 0]
                    counts[p] += np.bincount(own, minlength=len(books[p]))
                    safe = np.abs(cut[p].astype(float)).max(initial=0) * len(own) < V.EXACT
                    part = np.zeros((len(books[p]), wide), dtype=np.int64 if safe else object)
                    np.add.at(part, own, cut[p].astype(part.dtype))
                    sums[p] += part
                    near.append(state.near)
                    bound += [_down(state.lower), _down(state.outer)[:, None]]
                n = batch.num_rows
                near, bound = np.concatenate(near, axis=1), np.concatenate(bound, axis=1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([0] * n, pa.int32()), batch.column("_row"), batch.column("x"),
                     _rows_of(near.astype(np.int16)), _rows_of(bound),
                     *[pa.nulls(n, f.type) for f in TALLY_TYPES]], names=NAMES)
        if kind is None:
            return
        tally = []
        for p in range(parts):
            for e in np.flatnonzero(counts[p]).tolist():
                tally.append((p, e, None, int(counts[p][e]), [Decimal(int(v)) for v in sums[p][e]]))
            tally += [(p, None, z, n, None) for z, n in uses[p].items()]
        n = len(tally)
        yield pa.RecordBatch.from_arrays(
            [pa.array([1] * n, pa.int32()), pa.nulls(n, kind), pa.nulls(n, pa.list_(pa.int64())),
             pa.nulls(n, pa.list_(pa.int16())), pa.nulls(n, pa.list_(pa.float32())),
             *[pa.array(list(c), f.type) for c, f in zip(zip(*tally, strict=True), TALLY_TYPES, strict=True)]], names=NAMES)

    return run


TALLY_TYPES = [pa.field("part", pa.int32()), pa.field("entry", pa.int32()), pa.field("used", pa.int32()),
               pa.field("n", pa.int64()), pa.field("sums", pa.list_(pa.decimal128(38, 0)))]
NAMES = ["kind", "_row", "x", "near", "bound", *[f.name for f in TALLY_TYPES]]


def _rows_of(m: np.ndarray) -> pa.Array:
    return C.lists(m.reshape(-1), np.arange(len(m) + 1) * m.shape[1], pa.from_numpy_dtype(m.dtype))


def _codes(books: list[np.ndarray], moves: list[np.ndarray] | None, widths: list[int]):
    """The final assignment: code and error of each row."""
    parts, wide = len(books), books[0].shape[1]

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                _, cut = _cut(batch, parts * wide, parts)
                states = _read_bounds(batch, widths) if moves else None
                codes, error = [], 0
                for p in range(parts):
                    if moves:
                        state, own, _ = states[p].moved(cut[p], books[p], moves[p], widths[p])
                    else:
                        state, own = Bounds.compared(cut[p], books[p], 1)
                    codes.append(state.near[:, 0])
                    error = error + own.astype(object)
                text = ["".join(f"{c:02x}" for c in r) for r in np.stack(codes, axis=1).tolist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_row"), pa.array(text), pa.array([min(LONG, int(e)) for e in error], pa.int64())],
                    names=["_row", "code", "error"])

    return run


def _written(df: DataFrame, row: str) -> tuple[DataFrame, DataFrame, str]:
    """A round's rows and tallies, written once, and their folder."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "code-round")
    df.write.partitionBy("kind").parquet(path)
    return (spark.read.schema(STATE.format(row=row)).parquet(f"{path}/kind=0"),
            spark.read.schema(TALLY).parquet(f"{path}/kind=1"), path)


def _drop(spark: SparkSession, path: str):
    """Remove a table that a later one has replaced."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def refined(books: list[np.ndarray], tally: DataFrame) -> tuple[list[np.ndarray], list[dict[int, int]]]:
    """The next codebooks, and the number of rows by bounds used, from the tallies of all tasks."""
    spread = tally.where("entry is not null").select("part", "entry", "n", F.posexplode("sums").alias("at", "s"))
    got = spread.groupBy("part", "entry", "at").agg(F.sum("s").alias("s"), F.sum("n").alias("n")).collect()  # a row per component
    out = [b.copy() for b in books]
    for r in got:
        out[r["part"]][r["entry"], r["at"]] = int(r["s"]) // r["n"]
    uses: list[dict[int, int]] = [{} for _ in books]
    for r in tally.where("used is not null").groupBy("part", "used").agg(F.sum("n").alias("n")).collect():
        uses[r["part"]][r["used"]] = r["n"]
    return out, uses


def digest(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(v) for b in books for v in b.reshape(-1).tolist()).encode()).hexdigest()


def compress(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = PARTS,
             entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, list[np.ndarray]]:
    """(``_row`` of id and label, code and error of every whole vector; the codebooks)."""
    spark = vectors.sparkSession
    whole, x = V.floored(vectors, scale, vector)
    base = vectors.where(whole).select(F.struct(F.col(f"`{vec_id}`").alias("vec_id"), F.col(f"`{label}`").alias("label")).alias("_row"),
                                       x.alias("x"))
    row = C.ddl(base.schema["_row"].dataType)
    result = f"_row {row}, code string, error long"
    longest = base.agg(F.max(F.size("x"))).first()[0]
    if longest is None:
        return spark.createDataFrame([], result), []
    wide = max(1, -(-longest // parts))
    first = base.orderBy(F.asc_nulls_last("_row.vec_id"), "x").limit(entries).select("x").collect()  # bounded
    start = np.zeros((len(first), parts * wide), dtype=np.int64)
    for i, r in enumerate(first):
        start[i, :len(r["x"])] = r["x"]
    books = [b.copy() for b in np.split(start, parts, axis=1)]
    widths = [min(FIRST_B, len(first))] * parts
    moves, rows, old, path = None, base, widths, None
    for _ in range(rounds):
        done = C.map_arrow(rows, _round(books, moves, old, widths), f"kind int, {STATE.format(row=row)}, {TALLY}")
        before = path
        rows, tally, path = _written(done, row)
        if before:
            _drop(spark, before)
        later, uses = refined(books, tally)
        moves = [move_lengths(a, b) for a, b in zip(books, later, strict=True)]
        books, old = later, widths
        widths = [min(adapted(b, u), len(first)) for b, u in zip(widths, uses, strict=True)]
    return C.map_arrow(rows, _codes(books, moves, old), result), books


#: Copies of a label's total, so that a label of very many rows is joined by several tasks.
SALTS = 16


def with_label_error(coded: DataFrame) -> DataFrame:
    """``label_error``: the errors of all rows with the same label (nulls together), summed."""
    coded = reliable_checkpoint(coded, "vector-codes")
    total = coded.groupBy(F.col("_row.label").alias("l")).agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("s"))
    total = total.select("l", F.least("s", F.lit(LONG).cast("decimal(38,0)")).cast("long").alias("label_error"),
                         F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    salted = coded.withColumn("salt", F.pmod(F.xxhash64("_row.vec_id", "code"), F.lit(SALTS)).cast("int"))
    return salted.join(total, F.col("_row.label").eqNullSafe(F.col("l")) & (salted["salt"] == total["salt"]))


def op12_vector_code_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = compress(C.table(spark, sf_dir, "embeddings"))
    return with_label_error(coded).select(F.col("_row.vec_id").alias("vec_id"), "code", "error", "label_error",
                                          F.lit(digest(books)).alias("codebooks_sha256"))
