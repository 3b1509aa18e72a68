"""The filter interaction audit against brute force."""
import random
import re
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest

from ridegrid.llm import filter_audit as A

WORD = re.compile(r"[^\x20\x09-\x0D]+")
RNG = random.Random(11)
BAG = ["alpha", "Beta", "beta", "déjà", "日本語", "x" * 9, "y" * 300, "y" * 299 + "z", "ab", "AB", "a&b", "w|"] + [f"w{i}" for i in range(400)]


def words(n, bag=BAG):
    return " ".join(RNG.choice(bag) for _ in range(n))


TEXTS = [None, "", " \n\t", "one", "One one", words(250), words(250, BAG[12:]), words(900, BAG[12:60]), "A" * 500, "x" * 20000,
         words(3000), "\x0b".join(["日本 語"] * 150), "é" * 7 + "\r\n" + "é" * 8, words(199, BAG[12:]), words(200, BAG[12:]), "a b", "ab ", "ab"]


def brute(t):
    t = t or ""
    w = WORD.findall(t)
    return (len(w), len(set(w)), sum("A" <= c <= "Z" for c in t), len(t), sum(c in "#$%&*|" for c in t))


@pytest.mark.parametrize("block", [1, 7, 64, 1000, 1 << 22])
def test_transducer_counts(block):
    texts = TEXTS if block > 7 else [t for t in TEXTS if t is None or len(t) < 300]
    got = A.measures(pa.array(texts, pa.string()), block)
    assert list(zip(*[got[m].tolist() for m in A.MEASURES], strict=True)) == [brute(t) for t in texts]


def test_equal_hashes_are_verified(monkeypatch):
    monkeypatch.setattr(A.WordTable, "hashes", lambda self, text, start, length: np.zeros(len(text), np.uint64))
    got = A.measures(pa.array([t for t in TEXTS if len(t or "") < 2000], pa.string()), 500)
    assert got["n_distinct"].tolist() == [brute(t)[1] for t in TEXTS if len(t or "") < 2000]


def test_words_of_long_texts_pass_in_blocks():
    text = words(200_000) + " " + "q" * 3_000_000
    got = A.measures(pa.array([text], pa.string()), 1 << 16)
    assert tuple(int(got[m][0]) for m in A.MEASURES) == brute(text)


def corpus():
    rows = [(i, t, RNG.choice(["en", "de", None, ""])) for i, t in enumerate(TEXTS)]
    rows += [(100 + i, TEXTS[6], "en") for i in range(40)]  # a large group of copies
    rows += [(6, TEXTS[6], "de"), (6, TEXTS[6], "de"), (6, "other", "de"), (None, TEXTS[6], "en"), (None, "lonely", None), (None, "lonely", None)]
    rows += [(200 + i, words(RNG.randrange(1, 500)), RNG.choice(["en", "de"])) for i in range(60)]
    labels = [(i, RNG.choice([0, 1, None]), RNG.choice([0, 1, None])) for i in range(0, 260, 2)]
    return rows, labels + [(6, 1, 0), (6, 0, 1), (None, 1, 1), (999, 1, 1)]


def audit(rows, labels):
    first = {}
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    judged = []
    for i, t, part in rows:
        w, d, caps, points, symbols = brute(t)
        fails = "".join(f for f, bad in zip("ABCDE", (w < 200, 100 * d < 50 * w, 100 * caps > 3 * points, symbols > 0,
                                                      i is not None and i > first[t or ""])) if bad)
        own = [x for x in labels if x[0] == i and i is not None]
        judged.append((part or "", fails, any(x[1] == 1 for x in own), any(x[2] == 1 for x in own)))
    out = []
    for part in {j[0] for j in judged}:
        mine, shapley, table = [j for j in judged if j[0] == part], dict.fromkeys("ABCDE", 0), []
        for order in permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order, start=1):
                hit = [j for j in left if f in j[1]]
                before = [j for j in mine if j not in left and f in j[1]]
                redundant = sum(f in j[1] for j in mine) - len(hit)
                left = [j for j in left if f not in j[1]]
                shapley[f] += len(hit)
                assert len(before) <= redundant
                table.append((part, "".join(order), step, len(left), len(hit), redundant, sum(j[1] == f for j in mine),
                              sum(j[2] for j in hit), sum(j[3] for j in hit)))
        out += [(*t, shapley[t[1][t[2] - 1]]) for t in table]
    return out


def test_audit_equals_replaying_documents(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame([(i, t, p, "clash", 1, 2, 3) for i, t, p in rows],
                                 "doc_id long, text string, lang string, part string, failed int, `a.b` int, _row int")
    known = spark.createDataFrame([(*x, "clash") for x in labels], "doc_id long, quality int, toxic int, good string")
    got = A.replay(A.failure_counts(docs, known))
    assert got.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost",
                           "toxic_lost", "shapley"]
    assert sorted(tuple(r) for r in got.collect()) == sorted(audit(rows, labels))
    assert A.replay(A.failure_counts(docs.limit(0), known)).collect() == []
    assert {r["good_lost"] for r in A.replay(A.failure_counts(docs, known.limit(0))).collect()} == {0}
