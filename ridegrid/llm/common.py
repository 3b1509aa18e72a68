"""Helpers shared by the operators of this subpackage: Arrow batches to numpy word arrays,
64-bit hashing, table access, and distributed connected components.

Conventions used by every operator here:

* A null text counts as empty.  A null id is an ordinary value unless the operator says otherwise.
* Operators read only the columns they are given by name; other columns, whatever they are
  called, travel in one struct and come back untouched.
"""
from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridegrid.session import reliable_checkpoint, scratch_path

#: Bytes of text that a task turns into word arrays at a time (a longer text is its own slice).
SLICE_BYTES = 4 << 20

#: Byte tables.  White space: \x20 and \x09-\x0D.  Every byte of a non-ASCII character is a word byte.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
ALNUM = np.zeros(256, dtype=bool)
ALNUM[list(range(0x30, 0x3A)) + list(range(0x61, 0x7B)) + list(range(0x80, 0x100))] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words whose output bits all depend on all input bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


ODD = np.uint64(0x9E3779B97F4A7C15)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_slices(batches: Iterator[pa.RecordBatch], text: int | str = "text",
                limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches, cut into runs of rows with at most ``limit`` bytes of text each."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(at, to - at)
            at = to


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts, offset of each text and of the end)."""
    texts = pc.fill_null(texts, "")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    kind = np.dtype(np.int64 if wide else np.int32)
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    off = np.frombuffer(offsets, kind, len(texts) + 1, texts.offset * kind.itemsize).astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


@dataclass
class Words:
    """The words of a slice of texts, as codes into a dictionary of the slice's distinct words."""

    codes: np.ndarray  # of each word
    offsets: np.ndarray  # of each text's first word, and the end
    vocab: pa.Array  # distinct words (large_binary)
    starts: np.ndarray  # byte offset of each word in ``data``
    ends: np.ndarray
    data: np.ndarray  # the bytes, after lower-casing
    text_offsets: np.ndarray

    @property
    def n(self) -> int:
        return len(self.codes)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.offsets)

    def doc(self) -> np.ndarray:
        """The text that each word belongs to."""
        return np.repeat(np.arange(len(self.offsets) - 1), self.counts)

    def left(self) -> np.ndarray:
        """Words from each word to the end of its text, itself included."""
        return np.repeat(self.offsets[1:], self.counts) - np.arange(self.n)

    def hashes(self, seed: int = 0) -> np.ndarray:
        """A 64-bit hash of each word: of each distinct one, the sum of its bytes' random values, weighted by
        the powers of an odd number, mixed with its length; ``seed`` sets the values and the number."""
        if not len(self.vocab):
            return np.zeros(0, np.uint64)
        data, off = utf8(self.vocab)
        sizes = np.diff(off)
        values = mix(np.arange(1, 257, dtype=np.uint64) * ODD ^ np.uint64(seed))
        power = np.full(int(sizes.max()), ODD ^ np.uint64(2 * seed), np.uint64)
        np.multiply.accumulate(power, out=power)
        at = np.arange(len(data)) - np.repeat(off[:-1], sizes)
        own = np.add.reduceat(values[data] * power[at], off[:-1])
        return mix(own ^ mix(sizes.astype(np.uint64)))[self.codes]


def words_of(texts: pa.Array, lower: bool = True, word_bytes: np.ndarray = NOT_SPACE) -> Words:
    data, off = utf8(texts)
    if lower:
        data = LOWER[data]
    inside = word_bytes[data]
    before = np.zeros(len(data) + 1, dtype=bool)
    before[1:] = inside
    before[off[:-1]] = False
    after = np.zeros(len(data) + 1, dtype=bool)
    after[:-1] = inside
    after[off] = False
    starts = np.flatnonzero(inside & ~before[:-1])
    ends = np.flatnonzero(inside & ~after[1:]) + 1
    at = np.zeros(len(starts) + 1, dtype=np.int64)
    np.cumsum(ends - starts, out=at[1:])
    flat = np.ascontiguousarray(data[inside])
    words = pa.Array.from_buffers(pa.large_binary(), len(starts),
                                  [None, pa.py_buffer(at), pa.py_buffer(flat)]).dictionary_encode()
    codes = words.indices.to_numpy().astype(np.int64)
    return Words(codes, np.searchsorted(starts, off), words.dictionary, starts, ends, data, off)


def rolling(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` consecutive words (of the whole slice; runs may cross texts)."""
    m = len(hashes) - k + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    out = hashes[:m].copy()
    for j in range(1, k):
        out *= ODD
        out += hashes[j:j + m]
    return mix(out)


def rows(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, type=f.type)
         for c, f in zip(columns, schema, strict=True)], schema=schema)


def lists(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def cover(starts: np.ndarray, lengths: np.ndarray | int, n: int) -> np.ndarray:
    """Which of ``n`` places lie in one of the spans."""
    depth = np.zeros(n + 1, dtype=np.int64)
    np.add.at(depth, starts, 1)
    np.add.at(depth, starts + lengths, -1)
    return np.cumsum(depth[:-1]) > 0


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values."""
    edge = np.diff(np.concatenate(([0], flags.astype(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


#: Workers give freed arrays of this many bytes or more back at once: those of a stage would stay for the next one.
#: Of smaller ones, they keep up to the second number free, as pages given back are faulted in again by the next array.
WORKERS = {"MALLOC_MMAP_THRESHOLD_": str(1 << 20), "MALLOC_TRIM_THRESHOLD_": str(16 << 20), "ARROW_DEFAULT_MEMORY_POOL": "system"}


def importable(spark: SparkSession) -> None:
    """Let Python workers on this machine import the package from where the driver has it, and set ``WORKERS``.

    A cluster gets the package like any other (``--py-files`` or an installed wheel), and its own
    ``spark.executorEnv`` settings hold.
    """
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, (root, known)))
    for name, value in WORKERS.items():
        if spark.conf.get(f"spark.executorEnv.{name}", None) is None:
            environment.setdefault(name, value)


def ddl(kind: T.DataType) -> str:
    """A type as text that Spark reads back, whatever the names of its fields."""
    if isinstance(kind, T.StructType):
        fields = (f"`{f.name.replace('`', '``')}`:{ddl(f.dataType)}" for f in kind.fields)
        return f"struct<{','.join(fields)}>"
    if isinstance(kind, T.ArrayType):
        return f"array<{ddl(kind.elementType)}>"
    if isinstance(kind, T.MapType):
        return f"map<{ddl(kind.keyType)},{ddl(kind.valueType)}>"
    return kind.simpleString()


def carried(docs: DataFrame, text: str, keep: Sequence[str] | None = None) -> tuple[DataFrame, str]:
    """(``_row``: the columns to carry along, all by default; ``_text``), and the type of ``_row``."""
    names = docs.columns if keep is None else keep
    df = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"), F.col(f"`{text}`").alias("_text"))
    return df, ddl(df.schema["_row"].dataType)


def carried_once(docs: DataFrame, text: str, keep: Sequence[str] | None = None) -> tuple[DataFrame, str, int | None]:
    """As ``carried``, but a text that is among the columns to carry travels in ``_row`` only: the last value is its
    place there, for ``with_text`` (none: it is ``_text``)."""
    names = docs.columns if keep is None else list(keep)
    df, kind = carried(docs, text, names)
    return (df.select("_row"), kind, names.index(text)) if text in names else (df, kind, None)


def with_text(batches: Iterator[pa.RecordBatch], at: int | None) -> Iterator[pa.RecordBatch]:
    """The batches with ``_text`` taken from the place ``at`` of ``_row`` (none: they have it); nothing is copied."""
    for batch in batches:
        row = batch.column("_row")
        yield batch if at is None else pa.RecordBatch.from_arrays([row, row.field(at)], names=["_row", "_text"])


def map_arrow(df: DataFrame, f: Callable, schema: str) -> DataFrame:
    importable(df.sparkSession)
    return df.mapInArrow(f, schema)


def clustered(df: DataFrame, keys: Sequence[str], name: str, **options: str) -> DataFrame:
    """``df`` written once below the shared checkpoint folder, in buckets by ``keys``, and read again.

    A join on the keys then moves the other side only.  The catalog knows the table while it is written and
    opened; its files stay.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    table, n = f"{name.replace('-', '_')}_{uuid.uuid4().hex}", int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    df.repartition(n, *keys).write.bucketBy(n, *keys).options(path=path, **options).saveAsTable(table)
    out = spark.table(table)
    spark.sql(f"DROP TABLE {table}")
    return out


#: Keys of fewer rows than this are never hot.
HOT_ROWS = 10_000


def join_hot(big: DataFrame, small: DataFrame, keys: Sequence[str], tie: Sequence[str]) -> DataFrame:
    """``big`` joined with ``small``, which has a row per key and ``c``, the key's rows in ``big``.

    The rows of a hot key are divided among several tasks by the hash of ``tie``, and the key's row is copied to
    them.  A key is hot above a share of the rows that at most four times as many keys as
    partitions can have; so many rows are broadcast at most.
    """
    spark = big.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    limit = max(HOT_ROWS, (small.agg(F.sum("c")).first()[0] or 0) // (4 * n))
    copies = F.expr(f"cast((c - 1) div {limit} as int)")
    hot = small.where(F.col("c") > limit).select(*keys, (copies + 1).alias("_copies"))
    salted = big.join(F.broadcast(hot), list(keys), "left").withColumn(
        "_salt", F.coalesce(F.pmod(F.xxhash64(*tie), F.col("_copies")).cast("int"), F.lit(0))).drop("_copies")
    return salted.join(small.withColumn("_salt", F.explode(F.sequence(F.lit(0), copies))), [*keys, "_salt"]).drop("_salt", "c")


def _is_star_forest(e: DataFrame) -> bool:
    """Whether every edge (u, v), u > v, leads straight to a root: one edge per u, and no u is a v."""
    ends = e.select(F.col("u").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("root")).unionByName(
        e.select(F.col("v").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("root")))
    seen = ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("root").alias("root"))
    return seen.where("out + root > 1").isEmpty()


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) of every node in ``edges`` (u, v): root is the component's smallest node.

    Alternating large-star and small-star steps: each keeps at most as many edges as before and
    needs one minimum per node (combined before the shuffle) and one join, so a node with very
    many links is split by the skew join like any other key.  Each step is a written table.
    Self-loops, repeated and null edges are allowed: loops and nulls give no row.
    """
    e = reliable_checkpoint(
        edges.toDF("u", "v").where("u is not null and v is not null and u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), name)
    while not _is_star_forest(e):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select(
            "u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = reliable_checkpoint(large.distinct(), name)
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(
            F.explode(F.array(F.struct("u", F.col("m").alias("v")),
                              F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x"))
        e = reliable_checkpoint(small.select("x.*").where("u <> v").distinct(), name)
    stars = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.unionByName(stars.select(F.col("root").alias("node"), "root").distinct())
