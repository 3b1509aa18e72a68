"""Operator 8, line dedup through a sharded minimal perfect hash.

Lines are known by two 64-bit hashes of their key (ends stripped of white space, A-Z lower-cased).
Keys of at least ``min_chars`` code points found in two documents or more are dealt into shards by
hash.  Each shard is one compact index: a minimal perfect hash (levels of bits in which each key
owns a bit, ranks giving its number), and under that number a fingerprint (the second hash), the
number of lines and the first document.  Documents send the hashes of their lines to the
shards and read the arrays there; only lines to be dropped come back.

A shard is sized by its number of keys.  A shard whose lines are asked for very often (a line in a
third of all documents) is copied, and its askers are divided among the copies.

Defined cases: a null or empty text is one empty line; an empty or short key is never dropped; a
null id counts as one document after all others; rows that repeat an id are one document (all of
them keep a line that this id holds first); all lines dropped leave an empty text; an empty table
gives an empty result; other columns come back untouched.
"""
from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridegrid.llm import common as C
from ridegrid.session import reliable_checkpoint

MIN_CHARS = 10
LAST = (1 << 63) - 1
STRIP = b" \t\n\x0b\x0c\r"


def line_keys(text: str | None, min_chars: int = MIN_CHARS) -> list[tuple[int, bytes]]:
    """(line number, 16-byte hash of the key) of the lines whose key is long enough."""
    found = []
    for i, line in enumerate((text or "").split("\n")):
        if len(line) < min_chars:
            continue
        key = line.encode().strip(STRIP)
        if len(key) >= 4 * min_chars or len(key.decode()) >= min_chars:
            found.append((i, hashlib.blake2b(key.lower(), digest_size=16).digest()))
    return found


def _lines(min_chars: int):
    schema = pa.schema([("doc", pa.int64()), ("th", pa.int64()), ("line", pa.int32()),
                        ("h1", pa.int64()), ("h2", pa.int64())])

    def run(batches):
        for batch in C.text_slices(batches, "_text"):
            numbers, keys, sizes = [], [], []
            for text in batch.column("_text").to_pylist():
                found = line_keys(text, min_chars)
                sizes.append(len(found))
                numbers += [i for i, _ in found]
                keys += [k for _, k in found]
            h = np.frombuffer(b"".join(keys), np.int64).reshape(-1, 2)
            doc = np.repeat(batch.column("_doc").to_numpy(), sizes)
            th = np.repeat(batch.column("_th").to_numpy(), sizes)
            yield C.rows(schema, doc, th, np.array(numbers, np.int32),
                         np.ascontiguousarray(h[:, 0]), np.ascontiguousarray(h[:, 1]))

    return run


class PerfectHash:
    """A minimal perfect hash of distinct 64-bit hashes: levels of bits, each key alone on its bit."""

    def __init__(self, keys: np.ndarray, gamma: float = 1.5):
        self.sizes: list[int] = []
        bits, rest = [], keys.astype(np.uint64)
        while len(rest):
            size = max(8, int(gamma * len(rest)) + 1)
            place = self.place(rest, len(self.sizes), size)
            count = np.bincount(place, minlength=size)
            bits.append(count == 1)
            self.sizes.append(size)
            rest = rest[count[place] > 1]
        self._fill(np.concatenate(bits) if bits else np.zeros(0, bool))

    def _fill(self, bits: np.ndarray):
        self.bits = bits
        self.ranks = np.zeros(len(bits) + 1, dtype=np.int64)
        np.cumsum(bits, out=self.ranks[1:])

    @staticmethod
    def place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        seed = np.uint64((0x9E3779B97F4A7C15 * (level + 1)) & (2**64 - 1))
        return (C.mix(keys ^ seed) % np.uint64(size)).astype(np.int64)

    def number(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key; a key that is not in the set gets any number, or -1."""
        out = np.full(len(keys), -1, dtype=np.int64)
        keys, open_, start = keys.astype(np.uint64), np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes):
            at = start + self.place(keys[open_], level, size)
            own = self.bits[at]
            out[open_[own]] = self.ranks[at[own]]
            open_ = open_[~own]
            start += size
        return out

    def dump(self) -> tuple[list[int], bytes]:
        return self.sizes, np.packbits(self.bits).tobytes()

    @classmethod
    def load(cls, sizes, packed: bytes) -> PerfectHash:
        self = cls.__new__(cls)
        self.sizes = list(sizes)
        self._fill(np.unpackbits(np.frombuffer(packed, np.uint8), count=sum(self.sizes)).astype(bool))
        return self


def single(h1: np.ndarray, h2: np.ndarray, seed: int) -> np.ndarray:
    """One 64-bit word of two."""
    h1, h2 = h1.astype(np.uint64), h2.astype(np.uint64)
    return C.mix(h1 ^ np.uint64(seed)) ^ h2 if seed else h1


INDEX = "shard int, seed long, sizes array<int>, bits binary, fingerprints binary, counts binary, first binary"


def _build(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
    h1, h2 = (t.column(c).to_numpy() for c in ("h1", "h2"))
    seed = 0
    while len(np.unique(single(h1, h2, seed))) < len(h1):
        seed += 1  # two pairs of hashes that agree in one word: try another mixture of theirs
    keys = single(h1, h2, seed)
    index = PerfectHash(keys)
    order = np.argsort(index.number(keys))

    def raw(values):
        return pa.array([np.ascontiguousarray(values[order]).tobytes()], pa.binary())

    sizes, packed = index.dump()
    return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()),
                     "seed": pa.array([seed], pa.int64()), "sizes": pa.array([sizes], pa.list_(pa.int32())),
                     "bits": pa.array([packed], pa.binary()), "fingerprints": raw(h2),
                     "counts": raw(t.column("n").to_numpy()), "first": raw(t.column("first").to_numpy())})


def _probe(asked: pa.Table, index: pa.Table) -> pa.Table:
    names = ["doc", "th", "line", "n"]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64()]
    if not asked.num_rows or not index.num_rows:
        return pa.table({n: pa.array([], k) for n, k in zip(names, kinds, strict=True)})
    r = index.slice(0, 1).to_pylist()[0]
    own = PerfectHash.load(r["sizes"], r["bits"])
    prints, counts, first = (np.frombuffer(r[c], np.int64) for c in ("fingerprints", "counts", "first"))
    number = own.number(single(asked.column("h1").to_numpy(), asked.column("h2").to_numpy(), r["seed"]))
    doc = asked.column("doc").to_numpy()
    known = number >= 0
    at = np.where(known, number, 0)
    drop = np.flatnonzero(known & (prints[at] == asked.column("h2").to_numpy()) & (first[at] != doc))
    return pa.table({"doc": pa.array(doc[drop], pa.int64()), "th": asked.column("th").take(pa.array(drop)),
                     "line": asked.column("line").take(pa.array(drop)), "n": pa.array(counts[at[drop]], pa.int64())})


def _rebuild(batches):
    for batch in C.text_slices(batches, "_text"):
        texts, lines, gone = [], [], []
        for text, drops in zip(batch.column("_text").to_pylist(), batch.column("_drops").to_pylist(), strict=True):
            parts = (text or "").split("\n")
            out = set(drops or ())
            texts.append("\n".join(p for i, p in enumerate(parts) if i not in out) if out else text or "")
            lines.append(len(parts))
            gone.append(len(out))
        yield pa.RecordBatch.from_arrays(
            [batch.column("_row"), pa.array(lines, pa.int64()), pa.array(gone, pa.int64()),
             pa.array(texts, pa.string())], names=["_row", "n_lines", "n_dropped", "kept_text"])


def drop_repeated_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                        min_chars: int = MIN_CHARS, keys_per_shard: int = 500_000,
                        lines_per_copy: int = 500_000, keep=None) -> DataFrame:
    """Every row of ``docs`` (struct ``_row``, of the columns in ``keep``, all by default) with
    n_lines, n_dropped and ``kept_text``."""
    names = docs.columns if keep is None else keep
    df = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"), F.col(text).alias("_text"),
                     F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST)).alias("_doc"),
                     F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("_th"))
    lines = C.map_arrow(df.select("_doc", "_th", "_text"), _lines(min_chars),
                        "doc long, th long, line int, h1 long, h2 long")
    lines = reliable_checkpoint(lines, "lines")  # numbers only; read by the count and by the probe
    # one row per key and task goes out; two documents at least: the smallest is not the largest
    seen = lines.groupBy("h1", "h2").agg(F.min("doc").alias("first"), F.max("doc").alias("last"),
                                         F.count("*").alias("n")).where("first <> last").drop("last")
    seen = reliable_checkpoint(seen, "repeated-lines")
    keys = seen.count()
    shards = 1 + keys // keys_per_shard
    shard = F.pmod(F.shiftright("h2", 20), F.lit(shards)).cast("int")
    built = seen.withColumn("shard", shard)
    index = reliable_checkpoint(built.groupBy("shard").applyInArrow(_build, INDEX), "line-index")
    asked = lines.withColumn("shard", shard)
    load = asked.groupBy("shard").count().select("shard", (1 + F.floor(F.col("count") / lines_per_copy)).cast("int")
                                                 .alias("copies"))  # a row per shard
    load = reliable_checkpoint(load, "line-shards")
    copies = index.join(load, "shard").withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    if shards == 1:  # one shard: its number of copies is a constant
        n = (load.agg(F.max("copies")).first()[0]) or 1
        asked = asked.withColumn("copies", F.lit(n))
    else:
        asked = asked.join(F.broadcast(load), "shard")  # bounded: a row per keys_per_shard keys
    asked = asked.withColumn("copy", F.pmod(F.xxhash64("doc", "th", "line"), F.col("copies")).cast("int")).drop("copies")
    dropped = asked.groupBy("shard", "copy").cogroup(copies.groupBy("shard", "copy")).applyInArrow(
        _probe, "doc long, th long, line int, n long")
    drops = dropped.groupBy("doc", "th").agg(F.collect_set("line").alias("_drops"))
    whole = df.join(drops, (F.col("_doc") == F.col("doc")) & (F.col("_th") == F.col("th")), "left")
    return C.map_arrow(whole.select("_row", "_text", "_drops"), _rebuild,
                       f"_row {C.ddl(df.schema['_row'].dataType)}, n_lines long, n_dropped long, kept_text string")


def dedup_documents(docs: DataFrame) -> DataFrame:
    """``docs`` with the kept lines as text, and n_chars to match."""
    out = drop_repeated_lines(docs, keep=[c for c in docs.columns if c != "text"])
    return out.select(*[F.col("kept_text").alias(c) if c == "text" else
                        F.char_length("kept_text").cast("long").alias(c) if c == "n_chars" else
                        F.col(f"_row.`{c}`").alias(c) for c in docs.columns])


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = drop_repeated_lines(C.table(spark, sf_dir, "documents"), keep=["doc_id"])
    return out.select("_row.doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text"), 256).alias("kept_sha256"))
