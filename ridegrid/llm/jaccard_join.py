"""Operator 5, n-gram Jaccard join with parity sketches.

A text's set holds its distinct five-word shingles.  Each shingle toggles (XORs) one bit of a wide
bit sketch, so two sketches differ in at most as many bits as the sets differ in shingles.  Sets
of sizes a and b with a Jaccard similarity of 3/4 or more differ in at most D = (a + b) / 7
shingles.  The sketch of a size band is cut into many segments; a pair can differ in D of them at
most, so among the first D + 1 non-empty segments of the set whose (D + 1)th comes first, one is
equal in both (pigeonhole).  Texts meet on these segments.  Segments of shingles found often in a
sample of the texts come last in the order, so they are used only by texts that have little else;
any order gives the same links, the sample only decides how many texts meet in vain.

In a bucket of equal segments, texts are not paired all with all: each meets the bucket's
representative, pairs are sifted by the Hamming distance of coarse sketches (dense ones folded; a
lower bound of the difference) and verified on the sets, and links are joined to components.  Buckets whose members
then lie in one component are settled.  In the others, members of different components go on
meeting: in large buckets first with further representatives, and then, in blocks of bounded size
inside a task, with all members of other components; only pairs whose sketches are near enough
leave the block, those of nearest members first, and the rest if that has not joined them.  So every link between different components is tried.

Defined cases: a null text, or one without words, has an empty set, no link, and is its own
component; equal texts are one class, verified once; fewer than five words are one shingle; a null
id never names a component that has another id; repeated rows give repeated rows; an empty table
gives an empty result; other columns are ignored.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ridegrid.llm import common as C
from ridegrid.session import reliable_checkpoint

SHINGLE = 5
#: Text in a slice.
SLICE_BYTES = 2 << 20
#: Texts whose shingles are counted to find frequent ones, the count that makes one frequent, and
#: how many are kept (the most frequent; 16 bytes each are sent to the tasks).
SAMPLE_TEXTS, FREQUENT, MAX_FREQUENT = 20_000, 3, 1 << 19
#: Buckets of frequent segments are met in this many parts first.
PARTS = 16
#: Larger buckets meet this many further representatives before their other members.
SMALL, MORE_ROUNDS = 12, 1
#: Members of a bucket in one block.
BLOCK = 512
#: Up to this many texts to verify are named to the tasks (16 bytes each), so that only those move; more are
#: left to the join, in which Spark's own run-time filters leave out most others.
NAMED_TEXTS = 1_000_000


def distinct(h: np.ndarray) -> np.ndarray:
    """The distinct values of ``h`` (one at least), sorted."""
    h = np.sort(h)
    new = np.ones(len(h), dtype=bool)
    np.not_equal(h[1:], h[:-1], out=new[1:])
    return h[new]


def shingle_sets(texts: pa.Array, k: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    w = C.words_of(texts)
    hashes = w.hashes()
    h = C.rolling(hashes, k)
    sets = []
    for a, b in zip(w.offsets[:-1].tolist(), w.offsets[1:].tolist(), strict=True):
        if b - a >= k:
            sets.append(distinct(h[a:b - k + 1]))
        elif b > a:
            sets.append(C.rolling(hashes[a:b], b - a) ^ np.uint64(b - a))
        else:
            sets.append(h[:0])
    return sets


class Frequent:
    """Frequent shingles, by hash, with their place in the order (rarest first)."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray):
        by = np.argsort(hashes)
        self.hashes = hashes[by]
        place = np.empty(len(by), dtype=np.int64)
        place[np.lexsort((self.hashes, counts[by]))] = np.arange(len(by))
        self.place = place
        self.maybe = np.zeros(1 << 20, dtype=bool)
        self.maybe[(hashes & np.uint64((1 << 20) - 1)).astype(np.int64)] = True

    def find(self, h: np.ndarray) -> np.ndarray:
        """The place of each hash, -1 if it is not frequent."""
        out = np.full(len(h), -1, dtype=np.int64)
        if not len(self.hashes):
            return out
        ask = np.flatnonzero(self.maybe[(h & np.uint64((1 << 20) - 1)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.hashes, h[ask]), len(self.hashes) - 1)
        hit = self.hashes[at] == h[ask]
        out[ask[hit]] = self.place[at[hit]]
        return out


def size_bands(n: int) -> list[tuple[int, int, int]]:
    """(band, first size beyond it, most differing shingles) of the bands where a set of n can meet.

    Bands run from a power of four to the next; a pair meets in the band of its larger set.
    """
    if n < 1:
        return []
    band = (n.bit_length() - 1) // 2
    limit, widest = 4 ** (band + 1), 4 * n // 3
    out = [(band, limit, (n + min(widest, limit - 1)) // 7)]
    if widest >= limit:
        out.append((band + 1, 4 * limit, (n + widest) // 7))
    return out


def segment_keys(h: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket key, whether it stems from a frequent shingle) of one set's first segments."""
    often = place >= 0
    rare, often = h[~often], h[often][np.argsort(place[often])]
    mixed = C.mix(rare)
    keys, hot = [], []
    for band, limit, most in size_bands(len(h)):
        # small sets: each shingle has a segment of its own; else two segments per possible shingle
        segment = rare if limit <= 64 else mixed % np.uint64(2 * limit)
        by = np.argsort(segment)
        segment, bit = segment[by], mixed[by]
        new = np.ones(len(by), dtype=bool)
        np.not_equal(segment[1:], segment[:-1], out=new[1:])
        head = np.flatnonzero(new)
        use = head[:most + 1]
        # the toggled bits of each segment that is used
        end = head[len(use)] if len(use) < len(head) else len(by)
        parity = np.bitwise_xor.reduceat(bit[:end], use) if len(use) else bit
        here = C.mix(segment[use] + np.uint64(int(C.ODD) * (band + 1) % (1 << 64))) ^ parity
        more = C.mix(often[:most + 1 - len(use)] ^ np.uint64(band + 1))
        keys += [here, more]
        hot += [np.zeros(len(here), bool), np.ones(len(more), bool)]
    if not keys:
        return h[:0], np.zeros(0, bool)
    return np.concatenate(keys), np.concatenate(hot)


def dense_sketch(h: np.ndarray) -> bytes:
    """Parity of the shingles per bit, over a power of two of 2n bits or more, 2,048 at least."""
    bits = 1 << max(11, (2 * len(h) - 1).bit_length())
    at = (h & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=bits) & 1).astype(np.uint8), bitorder="little").tobytes()


def folded(sketch: np.ndarray, words: int) -> np.ndarray:
    """A sketch of 64-bit words folded (XOR of its halves) to fewer words."""
    while len(sketch) > words:
        sketch = sketch[:len(sketch) // 2] ^ sketch[len(sketch) // 2:]
    return sketch


def coarse_sketch(sketch: bytes, n: int) -> bytes:
    """The dense sketch of a set of n folded to a power of two of n bits or more, 256 at least."""
    words = (1 << max(8, (max(n, 1) - 1).bit_length())) // 64
    return folded(np.frombuffer(sketch, np.uint64), words).tobytes()


def hamming(a: bytes, b: bytes) -> int:
    """Differing bits of two sketches, the longer one folded to the shorter."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    words = min(len(x), len(y))
    return int(np.bitwise_count(folded(x, words) ^ folded(y, words)).sum())


def near_in_block(left: list[tuple], right: list[tuple], nearest: bool = False):
    """Pairs (cid, cid) of two lists of (cid, label, n, sketch) that may be linked: other label,
    sizes within 3/4, sketches no further apart than a link allows.

    ``nearest``: only the nearest such member of ``right`` for each of ``left``.
    """
    if not left or not right:
        return
    words = min(len(x[3]) for x in (*left, *right)) // 8
    sketch = np.stack([folded(np.frombuffer(x[3], np.uint64), words) for x in right])
    label = np.array([x[1] for x in right])
    n = np.array([x[2] for x in right])
    for cid, own, size, bits in left:
        able = np.flatnonzero((label != own) & (4 * np.minimum(n, size) >= 3 * np.maximum(n, size)))
        if len(able):
            apart = np.bitwise_count(sketch[able] ^ folded(np.frombuffer(bits, np.uint64), words)).sum(axis=1)
            close = np.flatnonzero(apart <= (n[able] + size) // 7)
            if nearest and len(close):
                close = close[[np.argmin(apart[close])]]
            for j in able[close].tolist():
                yield cid, right[j][0]


def _meet(nearest: bool):
    """Runs of rows of one (key, i, j): the cells of unsettled buckets, see ``_unsettled_pairs``."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def found(pairs):
        return C.rows(schema, np.array([a for a, _ in pairs], np.int64), np.array([b for _, b in pairs], np.int64))

    def run(batches):
        cell, apart, whole, out = None, [], [], set()
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[:3] != cell:
                    out.update(near_in_block(apart, whole, nearest))
                    cell, apart, whole = row[:3], [], []
                (apart if row[3] else whole).append(row[4:])
            yield found(out)
            out = set()
        yield found(set(near_in_block(apart, whole, nearest)))

    return run


def _shingles(batches):
    schema = pa.schema([("h", pa.int64())])
    for batch in C.text_slices(batches, "text", SLICE_BYTES):
        sets = shingle_sets(batch.column("text"))
        yield C.rows(schema, np.concatenate(sets).view(np.int64))


def _profiles(batches):
    for batch in C.text_slices(batches, "text", SLICE_BYTES):
        sets = shingle_sets(batch.column("text"))
        sketch = [dense_sketch(s) for s in sets]
        coarse = [coarse_sketch(x, len(s)) for x, s in zip(sketch, sets, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("cid"), pa.array([len(s) for s in sets], pa.int64()), pa.array(sketch, pa.binary()),
             pa.array(coarse, pa.binary())], names=["cid", "n", "sketch", "coarse"])


def _keys(shared):
    schema = pa.schema([("key", pa.int64()), ("cid", pa.int64()), ("part", pa.int32())])

    def run(batches):
        frequent = shared.value
        for batch in C.text_slices(batches, "text", SLICE_BYTES):
            sets = shingle_sets(batch.column("text"))
            ends = np.cumsum([len(s) for s in sets])
            place = np.split(frequent.find(np.concatenate(sets)), ends[:-1])
            found = [segment_keys(s, p) for s, p in zip(sets, place, strict=True)]
            sizes = [len(k) for k, _ in found]
            cid = np.repeat(batch.column("cid").to_numpy(), sizes)
            hot = np.concatenate([x for _, x in found])
            yield C.rows(schema, np.concatenate([k for k, _ in found]).view(np.int64), cid,
                         np.where(hot, cid % PARTS, -1).astype(np.int32))

    return run


def _near(batches):
    for batch in batches:
        a, b = batch.column("sa").to_pylist(), batch.column("sb").to_pylist()
        most = ((batch.column("na").to_numpy() + batch.column("nb").to_numpy()) // 7).tolist()
        keep = [hamming(x, y) <= d for x, y, d in zip(a, b, most, strict=True)]
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _verify(batches):
    for batch in C.text_slices(batches, "ta", SLICE_BYTES):
        a, b = shingle_sets(batch.column("ta")), shingle_sets(batch.column("tb"))
        keep = []
        for x, y in zip(a, b, strict=True):
            both = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(both > 0 and 100 * both >= 75 * (len(x) + len(y) - both))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def frequent_shingles(texts: DataFrame, count: int) -> Frequent:
    share = max(1, count // SAMPLE_TEXTS)
    sample = texts.where(F.pmod(F.xxhash64("m"), F.lit(share)) == 0).select("text")
    found = (C.map_arrow(sample, _shingles, "h long").groupBy("h").agg(F.count("*").alias("c"))
             .where(F.col("c") >= FREQUENT).orderBy(F.desc("c"), "h").limit(MAX_FREQUENT).toPandas())
    return Frequent(found["h"].to_numpy(np.int64).view(np.uint64), found["c"].to_numpy(np.int64))


def _links(pairs: DataFrame, profiles: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets have a Jaccard similarity of 3/4 or more."""
    a = profiles.select(F.col("cid").alias("a"), F.col("n").alias("na"), F.col("coarse").alias("sa"))
    b = profiles.select(F.col("cid").alias("b"), F.col("n").alias("nb"), F.col("coarse").alias("sb"))
    sized = pairs.join(a, "a").join(b, "b").where("4 * least(na, nb) >= 3 * greatest(na, nb)")
    near = reliable_checkpoint(C.map_arrow(sized.select("a", "b", "na", "nb", "sa", "sb"), _near, "a long, b long"),
                               "near-pairs")
    if near.count() <= NAMED_TEXTS // 2:
        named = near.select(F.explode(F.array("a", "b")).alias("cid")).distinct()
        texts = texts.join(F.broadcast(named), "cid", "left_semi")
    ta = texts.select(F.col("cid").alias("a"), F.col("text").alias("ta"))
    tb = texts.select(F.col("cid").alias("b"), F.col("text").alias("tb"))
    both = near.join(ta, "a").join(tb, "b").select("a", "b", "ta", "tb")
    return reliable_checkpoint(C.map_arrow(both, _verify, "a long, b long"), "links")


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def link_classes(texts: DataFrame, profiles: DataFrame) -> DataFrame:
    """(node, root) for every class of ``texts`` (cid, m, text) with a link to another."""
    spark = texts.sparkSession
    shared = spark.sparkContext.broadcast(frequent_shingles(texts, texts.count()))
    met = C.map_arrow(texts.select("cid", "text"), _keys(shared), "key long, cid long, part int")
    order = Window.partitionBy("key", "part").orderBy("cid")
    bucket = met.select(
        "key", "cid", "part", F.first("cid").over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("rep"),
        F.lead("cid").over(order).alias("_next"))
    bucket = bucket.where("rep <> cid or _next is not null or part >= 0").drop("_next")
    bucket = reliable_checkpoint(bucket, "buckets")
    pairs = bucket.select(F.col("rep").alias("a"), F.col("cid").alias("b"))
    reps = bucket.where("part >= 0").select("key", "rep").distinct()
    lowest = reps.groupBy("key").agg(F.min("rep").alias("a"))
    pairs = pairs.unionByName(reps.join(lowest, "key").select("a", F.col("rep").alias("b")))
    pairs = reliable_checkpoint(_ordered(pairs.where("a <> b")), "pairs")
    seen, links = pairs, _links(pairs, profiles, texts)
    roots = C.connected_components(links, "near-components")
    rows = bucket.select("key", "cid")
    for step in range(MORE_ROUNDS + 2):
        rows = _open_buckets(rows, roots)
        if step < MORE_ROUNDS:  # large buckets meet one more representative
            large = rows.where(F.col("size") > SMALL)
            by = F.struct(F.xxhash64("cid", F.lit(step)).alias("h"), "cid", "label")
            rep = large.groupBy("key").agg(F.min(by).alias("r"))
            pairs = large.join(rep, "key").where("label <> r.label").select(F.col("r.cid").alias("a"), F.col("cid").alias("b"))
        else:  # members meet the nearest member of other components, and when these are joined, all
            pairs = _unsettled_pairs(rows, profiles, step == MORE_ROUNDS)
        pairs = reliable_checkpoint(_ordered(pairs).join(seen, ["a", "b"], "left_anti"), "pairs")
        seen = seen.unionByName(pairs)
        # the components found so far stand for the links found so far
        links = roots.toDF("a", "b").unionByName(_links(pairs, profiles, texts))
        roots = C.connected_components(links, "near-components")
    return roots


def _open_buckets(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """(key, cid, label, size, common, apart) of the buckets ``rows`` (key, cid) whose members lie in
    several components: ``common`` is the label of most members, ``apart`` counts the others.

    A bucket of two is never open: its members have met.
    """
    named = rows.select("key", "cid").join(roots.withColumnRenamed("node", "cid"), "cid", "left").select(
        "key", "cid", F.coalesce("root", "cid").alias("label"))
    counts = named.groupBy("key", "label").agg(F.count("*").alias("n"))
    still = counts.groupBy("key").agg(F.sum("n").alias("size"), F.max(F.struct("n", "label")).alias("most"),
                                      F.count("*").alias("labels")).where("labels > 1 and size > 2")
    still = still.select("key", "size", F.col("most.label").alias("common"),
                         (F.col("size") - F.col("most.n")).alias("apart"))
    return reliable_checkpoint(named.join(still, "key"), "open-buckets")


def _unsettled_pairs(rows: DataFrame, profiles: DataFrame, nearest: bool) -> DataFrame:
    """Pairs (a, b) of different labels in the buckets ``rows`` (of ``_open_buckets``) that may be linked.

    Of two such members one at least does not have the common label.  So all members, in blocks i,
    meet those without it, in blocks j: a member's row goes to the cells (i, j) of its block i, and once
    more, if it has not the common label, to those of its block j.  Cells are bounded by the size of a block.
    """
    whole = rows.join(profiles.select("cid", "n", "sketch"), "cid").withColumn("_h", F.xxhash64("cid")).withColumn(
        "_is", F.expr(f"1 + size div {BLOCK}")).withColumn("_js", F.expr(f"1 + apart div {BLOCK}"))
    cells = F.expr("""concat(
        transform(sequence(0, _js - 1), x -> struct(pmod(_h, _is) as i, x as j, false as mover)),
        if(label = common, array(),
           transform(sequence(0, _is - 1), x -> struct(x as i, pmod(_h, _js) as j, true as mover))))""")
    dealt = whole.withColumn("_cell", F.explode(cells)).select(
        "key", F.col("_cell.i").alias("i"), F.col("_cell.j").alias("j"), F.col("_cell.mover").alias("mover"),
        "cid", "label", "n", "sketch")
    dealt = dealt.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return C.map_arrow(dealt, _meet(nearest), "a long, b long")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id and the text's hash ``m`` of every row of ``docs``."""
    base = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    texts = base.groupBy("text").agg(F.min("doc_id").alias("first"))
    texts = reliable_checkpoint(texts.select(F.monotonically_increasing_id().alias("cid"), "first",
                                             F.md5("text").alias("m"), "text"), "classes")
    profiles = reliable_checkpoint(C.map_arrow(texts.select("cid", "text"), _profiles,
                                               "cid long, n long, sketch binary, coarse binary"), "profiles")
    roots = link_classes(texts.select("cid", "m", "text"), profiles)
    named = texts.select("cid", "first", "m").join(profiles.select("cid", "n"), "cid").join(
        roots.withColumnRenamed("node", "cid"), "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    named = reliable_checkpoint(named, "named-classes")
    smallest = named.groupBy("root").agg(F.min("first").alias("component"))
    named = named.join(smallest, "root").select("m", "n", "component")
    return base.select("doc_id", F.md5("text").alias("m")).join(named, "m").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.coalesce("component", "doc_id")).alias("component_id"), "m")


def one_per_group(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id names its component, each once; rows without words stay.

    A row equal to another in id and text is the same row.  All columns are kept, whatever they are called.
    """
    first = near_duplicates(docs).where("component_id is null or doc_id <=> component_id").select(
        F.col("doc_id").alias("_id"), F.col("m").alias("_m")).distinct()
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col("doc_id").alias("_own"),
                       F.md5(F.coalesce(F.col("text"), F.lit(""))).alias("_hash"))
    kept = rows.join(first, F.col("_own").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_m")), "left_semi")
    return kept.dropDuplicates(["_own", "_hash"]).select(*[F.col(f"_row.`{c}`").alias(c) for c in docs.columns])


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(C.table(spark, sf_dir, "documents")).drop("m")
