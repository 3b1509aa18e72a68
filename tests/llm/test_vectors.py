"""The vector operators against brute force, on a table with every awkward case."""
import hashlib

import numpy as np
import pytest

from pyspark.sql import functions as F

from ridegrid.llm import vector_codes as K
from ridegrid.llm import vector_search as S
from ridegrid.llm import vectors as V

SCHEMA = "vec_id long, embedding array<float>, label int, x string, id int, row int, `a.b` int, _row string"
NAN, INF = float("nan"), float("inf")


def table():
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(6, 8))
    rows = []
    for i in range(420):
        v = centres[i % 6] * rng.choice([0.2, 1, 3]) + 0.05 * rng.normal(size=8)
        rows.append((i, [float(np.float32(c)) for c in v], None if i % 7 == 0 else i % 4))
    same = rows[100][1]
    rows += [(1000 + i, same, 9) for i in range(150)]  # a third of all rows hold one vector
    rows += [(50, rows[50][1], 1), (50, rows[50][1], 1), (100, rows[3][1], 2)]  # repeated rows, one id with two vectors
    rows += [(None, rows[7][1], 3), (-50, rows[9][1], 3), (2000, [0.0] * 8, 3)]
    rows += [(2050, None, 1), (2051, [1.0, None] + [0.0] * 6, 1), (2052, [NAN] + [0.0] * 7, 1), (2053, [0.0] * 7 + [-INF], 1)]
    rows += [(2100, [0.5] * 5, 1), (2101, [], None)]  # shorter ones
    return rows


ROWS = table()


@pytest.fixture(scope="module")
def vectors(spark):
    return spark.createDataFrame([(i, v, n, "clash", 1, 2, 3, "clash") for i, v, n in ROWS], SCHEMA)


def kept(scale, width=8):
    out = []
    for i, v, label in ROWS:
        if v is not None and all(c is not None and np.isfinite(c) for c in v):
            whole = [int(np.floor(scale * float(c))) for c in v]
            out.append((i, whole + [0] * (width - len(whole)), label))
    return out


def brute_top(rows, k):
    out = []
    for a, (i, x, _) in enumerate(rows):
        if i is None or i % 50:
            continue
        others = [(-sum(p * q for p, q in zip(x, y)), j is None, j or 0, j) for b, (j, y, _) in enumerate(rows) if a != b]
        out += [(i, r, j, -s) for r, (s, _, _, j) in enumerate(sorted(others, key=lambda o: o[:3])[:k], start=1)]
    return out


def in_order(rows):
    return sorted(rows, key=lambda r: tuple((v is None, v) for v in r))


@pytest.mark.parametrize("k, group_rows", [(5, 65536), (3, 40)])
def test_top_k_is_exact(vectors, k, group_rows, monkeypatch):
    monkeypatch.setattr(S, "LEAST_ROWS", group_rows if group_rows < 1000 else 1024)
    got = S.exact_top_k(vectors, F.col("vec_id") % 50 == 0, k, group_rows=group_rows)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert in_order(tuple(r) for r in got.collect()) == in_order(brute_top(kept(256), k))


def test_top_k_of_few_or_no_rows(spark, vectors):
    asks = F.col("vec_id") % 50 == 0
    assert S.exact_top_k(vectors.limit(0), asks).collect() == []
    assert S.exact_top_k(vectors.where("vec_id = 0"), asks).collect() == []
    assert S.exact_top_k(vectors.where("vec_id in (1, 2)"), asks).collect() == []
    few = S.exact_top_k(vectors.where("vec_id in (0, 1, 2)"), asks).collect()
    assert [r["rank"] for r in few] == [1, 2]


def test_top_k_of_huge_components(spark):
    rows = [(0, [1e7, 3.0]), (50, [1e7, 3.5]), (1, [-1e7, 1.0]), (2, [1e7, 3.25]), (3, [1e300, 0.0]), (4, [1e299, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [tuple(r)[2:] for r in S.exact_top_k(df, F.col("vec_id") == 0, 5).orderBy("rank").collect()]
    a = (256 * 10**7) ** 2  # beyond the whole numbers of a double; 50 and 2 differ in the last digits only
    assert got == [(3, (1 << 63) - 1), (4, (1 << 63) - 1), (50, a + 768 * 896), (2, a + 768 * 832), (1, -a + 768 * 256)]


def test_both_prunings_are_used_and_lose_nothing():
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(40, 16))
    x = np.floor(256 * (centres[rng.integers(0, 40, 3000)] + 0.03 * rng.normal(size=(3000, 16)))
                 * rng.choice([0.1, 0.5, 1.0, 1.5], size=(3000, 1))).astype(np.int64)
    length = np.sqrt((x.astype(float) ** 2).sum(axis=1))
    row = np.arange(len(x))
    search = S.Search(x[::50], row[::50], np.full(60, -np.inf), 5)
    for at in S.buckets(x, length):
        search.look(S.Bucket(x[at], length[at]), at, row[at])
    s = (x[::50] @ x.T).astype(float)
    s[np.arange(60), row[::50]] = -np.inf
    want = np.stack([np.lexsort((row, -r))[:5] for r in s])
    assert (search.place == want).all()
    assert search.pruned["bucket"] > 0 and search.pruned["coordinates"] > 0


@pytest.mark.parametrize("threshold", [0.2, 0.6, 0.9, 0.999])
def test_ranges_hold_every_vector_of_the_cosine(threshold):
    rng = np.random.default_rng(2)
    x = np.concatenate((rng.normal(size=(500, 4)), np.eye(4), -np.eye(4)))
    bucket = S.Bucket(x, np.sqrt((x ** 2).sum(axis=1)))
    for q in np.concatenate((x[:50], np.eye(4))):
        unit = q / np.sqrt(q @ q)
        near = np.flatnonzero(bucket.unit @ unit >= threshold)
        assert set(near) <= set(bucket.by_coordinates(unit, threshold))


def brute_codes(rows, parts=4, entries=256, rounds=4):
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    wide = len(rows[0][1]) // parts
    x = np.array([r[1] for r in rows], dtype=np.int64).reshape(len(rows), parts, wide)
    books = [x[:entries, p].copy() for p in range(parts)]
    for _ in range(rounds + 1):
        d = [((x[:, p, None, :] - books[p][None]) ** 2).sum(axis=2) for p in range(parts)]
        codes = [m.argmin(axis=1) for m in d]
        last = books
        books = [b.copy() for b in books]
        for p in range(parts):
            for e in set(codes[p].tolist()):
                own = x[codes[p] == e, p]
                books[p][e] = [int(s) // len(own) for s in own.sum(axis=0)]
    error = sum(m.min(axis=1) for m in d)
    out = [(r[0], "".join(f"{c[i]:02x}" for c in codes), int(error[i]), r[2]) for i, r in enumerate(rows)]
    text = ",".join(str(v) for b in last for v in b.reshape(-1).tolist())
    return out, hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("entries, rounds", [(256, 4), (7, 6), (64, 1)])
def test_codes_equal_plain_k_means(vectors, entries, rounds):
    coded, books = K.compress(vectors, entries=entries, rounds=rounds)
    want, digest = brute_codes(kept(1024), entries=entries, rounds=rounds)
    assert K.digest(books) == digest
    got = K.with_label_error(coded).select("_row.vec_id", "code", "error", "_row.label", "label_error").collect()
    assert in_order((r[0], r[1], r[2], r[3]) for r in got) == in_order(want)
    for r in got:
        assert r["label_error"] == sum(e for _, _, e, n in want if n == r["label"])


def test_codes_of_few_or_no_rows(vectors):
    coded, books = K.compress(vectors.limit(0))
    assert books == [] and K.with_label_error(coded).collect() == []
    coded, books = K.compress(vectors.where("vec_id = 3"))
    assert [(r["code"], r["error"]) for r in coded.collect()] == [("00000000", 0)] and len(books[0]) == 1


def test_codes_of_huge_components_are_exact(spark):
    rows = [(0, [1e12, 0.0, 0.0, 1.0], 1), (1, [1e12, 1.0, 0.0, 1.0], 1), (2, [1e12 + 0.5, 0.25, 0.0, 1.0], None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    coded, _ = K.compress(df, entries=2, rounds=2)
    rows = [(i, [int(np.floor(1024 * c)) for c in v], n) for i, v, n in rows]
    want = []
    books = [[[r[1][p]] for r in rows[:2]] for p in range(4)]
    for _ in range(3):
        at = [[min(range(2), key=lambda e: ((r[1][p] - books[p][e][0]) ** 2, e)) for r in rows] for p in range(4)]
        want = [("".join(f"{at[p][i]:02x}" for p in range(4)),
                 sum((r[1][p] - books[p][at[p][i]][0]) ** 2 for p in range(4))) for i, r in enumerate(rows)]
        for p in range(4):
            for e in range(2):
                own = [r[1][p] for i, r in enumerate(rows) if at[p][i] == e]
                if own:
                    books[p][e] = [sum(own) // len(own)]
    assert [(r["code"], r["error"]) for r in coded.orderBy("_row.vec_id").collect()] == want


def test_bounds_spare_comparisons_and_stay_true():
    rng = np.random.default_rng(8)
    x = np.floor(1024 * rng.normal(size=(4000, 16)) * 0.1).astype(np.int64)
    book = x[:256].copy()
    state, _ = K.Bounds.compared(x, book, 16)
    spared = 0
    for b in (16, 8, 24):
        later = book + rng.integers(-3, 4, book.shape)
        state, own, used = state.moved(x, later, K.move_lengths(book, later), b)
        book = later
        d = K.squares(x, book)
        assert (state.near[:, 0] == d.argmin(axis=1)).all() and (own == d.min(axis=1)).all()
        exact = np.sqrt(d)
        seen = np.where(state.near < 0, np.inf, np.take_along_axis(exact, state.near, 1))
        assert (np.where(state.near < 0, 0, state.lower) <= seen).all()
        others = exact.copy()
        r, c = np.nonzero(state.near >= 0)
        others[r, state.near[r, c]] = np.inf
        assert (state.outer <= others.min(axis=1)).all()
        spared += int((used >= 0).sum())
    assert spared > 6000  # most rows look at a few entries only


def test_b_adapts():
    assert K.adapted(16, {-1: 50, 0: 50}) == 32 and K.adapted(64, {-1: 100}) == 64
    assert K.adapted(16, {-1: 1, 0: 90, 3: 9}) == 5 and K.adapted(16, {0: 100}) == K.LEAST_B and K.adapted(16, {}) == 16


def test_matrix_fills_up():
    import pyarrow as pa
    assert V.matrix(pa.array([[1, 2], [], [3]]), 3).tolist() == [[1, 2, 0], [0, 0, 0], [3, 0, 0]]
    assert V.matrix(pa.array([[1, 2], [3, 4]]).slice(1)).tolist() == [[3, 4]]
