"""The pipeline's stages on the awkward corpus, each against plain Python on its own input."""
import hashlib
import os
import random
import re
import string
import tracemalloc

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from test_operators import ALNUM, ROWS, UP, WORD

from ridegrid.llm import common as C
from ridegrid.llm import decontamination, jaccard_join, pieces, quality_rules, secret_scan

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, _m string, _id long, _row string, _text string, "
          "`a.b` int, kept_text string, component_id long")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), "m", 5, "r", "t", 7, "k", 9) for i, t in ROWS], SCHEMA)


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("sf")
    items = [("b1", " ".join(ROWS[6][1].split()[10:60])), ("b2", "déjà VU ħ omega"), ("b2", "déjà VU ħ omega"), (None, None), ("b3", "")]
    spark.createDataFrame(items, "item_id string, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def key(rows):
    return sorted(rows, key=lambda r: tuple((v is None, str(v)) for v in r))


def plain(df):
    return [tuple(r) for r in df.collect()]


def covered(words, n):
    seen, places = {}, set()
    for i in range(len(words) - n + 1):
        seen.setdefault(tuple(words[i:i + n]), []).append(i)
    for at in seen.values():
        if len(at) > 1:
            places.update(j for i in at for j in range(i, i + n))
    return len(places)


def keeps_quality(text):
    w = WORD.findall(text or "")
    return not (len(w) < 20 or 100 * covered(w, 8) > 30 * len(w) or 100 * covered(w, 13) > 25 * len(w) or covered(w, 401))


def dedup_lines(rows):
    def line_key(line):
        k = line.strip(" \t\n\x0b\x0c\r").translate(UP)
        return k if len(k) >= 10 else None

    held = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            if (k := line_key(line)) is not None:
                held.setdefault(k, set()).add(i)
    out = []
    for i, t in rows:
        kept = []
        for line in (t or "").split("\n"):
            ids = held.get(line_key(line), {i})
            first = min((x for x in ids if x is not None), default=None)
            if len(ids) < 2 or i == first:
                kept.append(line)
        out.append("\n".join(kept))
    return out


def shingles(text):
    w = WORD.findall((text or "").translate(UP))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def one_of_each(rows):
    """Rows that name their component, each (id, text) once."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                root[find(a)] = find(b)
    kept, seen = [], set()
    for a, (i, t) in enumerate(rows):
        ids = [rows[b][0] for b in range(len(rows)) if find(b) == find(a) and rows[b][0] is not None]
        if (not sets[a] or i is None and not ids or i == min(ids, default=None)) and (i, t or "") not in seen:
            seen.add((i, t or ""))
            kept.append(a)
    return kept


def contaminated(text, items):
    w = ALNUM.findall((text or "").translate(UP))
    hit = set()
    for _, t in items:
        b = ALNUM.findall((t or "").translate(UP))
        n = min(13, len(b))
        for j in range(len(b) - n + 1 if n else 0):
            for i in range(len(w) - n + 1):
                if w[i:i + n] == b[j:j + n]:
                    hit.update(range(i, i + n))
    return bool(hit) and 20 * len(hit) >= len(w)


def test_quality_lines_and_encoding_stages(spark, docs, sf_dir):
    got = corpus_pipeline.quality(spark, docs, sf_dir)
    assert got.columns == docs.columns
    assert key(plain(got)) == key(r for r in plain(docs) if keeps_quality(r[1]))
    got = corpus_pipeline.lines(spark, docs, sf_dir)
    assert got.columns == docs.columns
    texts = dedup_lines(ROWS)
    assert key((r[0], r[1], r[4]) for r in plain(got)) == key((i, t, len(t)) for (i, _), t in zip(ROWS, texts, strict=True))
    assert {r[5:] for r in plain(got)} == {("m", 5, "r", "t", 7, "k", 9)}
    lanes = pieces.load(pieces.MODEL)
    coded = corpus_pipeline.encode(spark, docs, sf_dir).collect()
    assert key((r["doc_id"], None if r["ids"] is None else pieces.decode_ids(r["ids"], lanes.pieces)) for r in coded) == key(ROWS)


def test_near_duplicate_and_decontamination_stages(spark, docs, sf_dir):
    got = corpus_pipeline.near_duplicates(spark, docs, sf_dir)
    assert got.columns == docs.columns
    kept = one_of_each(ROWS)
    assert key((r[0], r[1] or "") for r in plain(got)) == key((ROWS[a][0], ROWS[a][1] or "") for a in kept)
    assert {r[5:] for r in plain(got)} == {("m", 5, "r", "t", 7, "k", 9)}
    items = [(r["item_id"], r["text"]) for r in C.table(spark, sf_dir, "benchmark").collect()]
    got = corpus_pipeline.decontaminate(spark, docs, sf_dir)
    assert key(plain(got)) == key(r for r in plain(docs) if not contaminated(r[1], items))
    assert got.count() < docs.count()


def test_whole_run_equals_the_stages_in_plain_python(spark, docs, sf_dir):
    docs.write.mode("overwrite").parquet(f"{sf_dir}/documents.parquet")
    items = [(r["item_id"], r["text"]) for r in C.table(spark, sf_dir, "benchmark").collect()]
    rows = [r for r in ROWS if keeps_quality(r[1])]
    rows = [(i, t) for (i, _), t in zip(rows, dedup_lines(rows), strict=True)]
    rows = [rows[a] for a in one_of_each(rows)]
    rows = [r for r in rows if not contaminated(r[1], items)]
    lanes = pieces.load(pieces.MODEL)
    got = corpus_pipeline.run(spark, sf_dir).collect()
    assert key((r["doc_id"], pieces.decode_ids(r["ids"], lanes.pieces)) for r in got) == key(rows)


def test_stages_of_an_empty_table(spark, docs, sf_dir):
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs.limit(0), sf_dir)
        assert out.count() == 0 and (name == "sentencepiece" or out.columns == docs.columns)


def test_benchmark_comes_in_measured_blocks(spark, docs):
    items = spark.createDataFrame([(str(i % 40), " ".join(f"w{i % 40}" for _ in range(30))) for i in range(200)] + [("big", "x " * 3000)],
                                  "item_id string, text string")
    n, blocks = decontamination._blocks(items, "item_id", "text", 500)
    parts = list(blocks)
    assert len(parts) == n > 5 and sum(map(len, parts)) == 41  # equal rows count once
    assert all(len(p) <= 1 or sum(len(t) for _, t in p) <= 500 for p in parts)
    some = spark.createDataFrame([("b", " ".join((max((t or "" for _, t in ROWS), key=len)).split()[50:90])), ("c", "two words here")],
                                 "item_id string, text string")
    one, many = (sorted(str(r) for r in decontamination.find_contamination(docs, some, block_bytes=b, keep=["doc_id"]).collect())
                 for b in (1 << 20, 10))
    assert one == many


def test_one_case_secrets_are_found_and_words_are_not():
    encode = secret_scan.vocabulary(secret_scan.VOCABULARY).encode_ordinary
    rng = random.Random(12)
    for letters in (string.ascii_lowercase, string.ascii_uppercase):
        for n in (24, 32, 40):
            runs = ["".join(rng.choice(letters) for _ in range(n)) for _ in range(300)]
            missed = [r for r in runs if not secret_scan.random_spans(f"see {r} here", [], encode, 2.1)]
            assert len(missed) <= 4, (n, missed)
    words = ("internationalization-of-the-telecommunication", "Donaudampfschifffahrtsgesellschaft", "anticonstitutionnellement_responsabilities",
             "CONSTITUTIONAL-RESPONSIBILITIES", "usr/local/share/documentation/packages", "2024-01-05/quarterly-report-of-the-company")
    for w in words:
        assert not secret_scan.random_spans(f"see {w} here", [], encode, 2.1), w
    assert re.fullmatch(secret_scan.RUN, words[0])


def test_encoding_holds_little_beside_a_batch():
    """The arrays of a task that encodes a batch of 8 MB with 400,000 different words."""
    rng = random.Random(17)
    words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randrange(5, 16))) for _ in range(400_000)]
    texts = [" ".join(rng.choices(words, k=300)) for _ in range(2_500)]
    rows = pa.StructArray.from_arrays([pa.array(range(len(texts)))], names=["doc_id"])
    batch = pa.RecordBatch.from_arrays([rows, pa.array(texts)], names=["_row", "_text"])
    pieces.load(pieces.MODEL)
    tracemalloc.start()
    try:
        out = list(pieces._encode(pieces.MODEL, digest=True)(iter([batch])))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    print("peak MB:", peak / 1e6)
    got = [d for b in out for d in b.column("decoded_sha256").to_pylist()]
    assert got == [hashlib.sha256(t.encode()).hexdigest() for t in texts]
    assert peak < 100e6


def test_quality_rules_and_decontamination_take_little_memory():
    rng = random.Random(3)
    words = ["".join(rng.choices(string.ascii_lowercase, k=rng.randint(2, 9))) for _ in range(20_000)]
    texts = [" ".join(rng.choices(words, k=1500)) for _ in range(900)]  # 9 MB
    item = " ".join(texts[5].split()[30:60])
    rows = pa.StructArray.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["doc_id", "text"])
    batch = pa.RecordBatch.from_arrays([rows], names=["_row"])

    class Shared:
        value = decontamination.Phrases([("b", item)], decontamination.WINDOW)

    def peak_of(run):
        tracemalloc.start()
        try:
            return list(run(iter([batch]))), tracemalloc.get_traced_memory()[1]
        finally:
            tracemalloc.stop()

    out, peak = peak_of(quality_rules._measure(quality_rules.Rules(), 1))
    assert [n for b in out for n in b.column("n_words").to_pylist()] == [1500] * len(texts)
    assert pa.Table.from_batches(out).column("_row").to_pylist() == rows.to_pylist()
    assert peak < 60e6
    out, peak = peak_of(decontamination._judge(Shared, 1))
    assert [i for i, x in enumerate(x for b in out for x in b.column("items").to_pylist()) if x] == [5]
    assert peak < 40e6


def test_texts_travel_to_python_once(docs, sf_dir, spark):
    benchmark = C.table(spark, sf_dir, "benchmark")
    for out in (quality_rules.judge(docs), decontamination.find_contamination(docs, benchmark)):
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert re.search(r"MapInArrow run\(_row#\d+\)", plan), plan
    assert re.search(r"MapInArrow run\(_row#\d+, _text#\d+\)",
                     quality_rules.judge(docs, keep=["doc_id"])._jdf.queryExecution().optimizedPlan().toString())


def test_python_workers_give_memory_back(spark):
    names = list(C.WORKERS)

    def settings(batches):
        for _ in batches:
            yield pa.RecordBatch.from_arrays([pa.array(names), pa.array([os.environ.get(n) for n in names])], names=["name", "value"])

    found = C.map_arrow(spark.range(1, numPartitions=1), settings, "name string, value string").collect()
    assert {r.name: r.value for r in found} == C.WORKERS
