"""The text operators on a small table with every awkward case, against brute force."""
import hashlib
import html
import math
import random
import re
import zlib
from urllib.parse import urljoin, urlsplit

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ridegrid.llm import attention_model as A
from ridegrid.llm import common as C
from ridegrid.llm import (decontamination, jaccard_join, line_dedup, lm_scoring, pieces, quality_rules, secret_scan,
                          sharding, substring_dedup, url_filter)

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UP = {i: i + 32 for i in range(65, 91)}
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _text string, ids string, k int"


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def corpus():
    rng = random.Random(3)
    bag = ["alpha", "Beta", "gamma9", "déjà", "vu", "ħ", "omega", "the", "of", "and", "x1", "naïve"] + [
        f"w{i}" for i in range(60)]

    def words(n):
        return " ".join(rng.choice(bag) for _ in range(n))

    base, passage, line = words(120), words(60), "A very common footer line, all rights reserved"
    near = base.split()
    near[50] = "CHANGED"
    texts = [
        None, "", " \t\n ", "one", "ONE", "two words here", base, base, " ".join(near), base.upper(),
        words(40) + " " + passage + " " + words(30), passage + "\n" + words(25), words(300) + " " + passage,
        line + "\n" + words(30) + "\n" + line, "  " + line.upper() + "\t\n" + words(22), line, words(9) + "\n" + words(9),
        " ".join([words(12)] * 6), "rep " * 50, words(6000), "x" * 20000, "tab\tand\x0bvt\r\nline  two▁  end ",
        "a\n\n\nb", words(20), words(21), "日本語 テキスト " * 12, "# * $ % & | < > " * 10,
    ]
    rows = [(i * 3, t) for i, t in enumerate(texts)]
    rows += [(18, base), (18, base), (66, words(35))]  # repeated rows, and one id with two texts
    rows += [(None, None)]
    return rows


ROWS = corpus()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), "clash", "clash", 1) for i, t in ROWS], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_words_match_the_pattern():
    texts = [t for _, t in ROWS]
    for lower, table, pattern in ((True, C.NOT_SPACE, WORD), (True, C.ALNUM, ALNUM), (False, C.NOT_SPACE, WORD)):
        w = C.words_of(pa.array(texts, pa.string()), lower=lower, word_bytes=table)
        vocab = [x.decode() for x in w.vocab.to_pylist()]
        for d, t in enumerate(texts):
            got = [vocab[c] for c in w.codes[w.offsets[d]:w.offsets[d + 1]]]
            assert got == pattern.findall((t or "").translate(UP) if lower else t or "")


def test_quality_rules(docs, empty):
    for r in quality_rules.judge(docs).collect():
        t = r["_row"]["text"] or ""
        w = WORD.findall(t)

        def covered(n):
            seen, out = {}, set()
            for i in range(len(w) - n + 1):
                seen.setdefault(tuple(w[i:i + n]), []).append(i)
            for places in seen.values():
                for i in places if len(places) > 1 else ():
                    out.update(range(i, i + n))
            return len(out)

        lines = [x for x in t.split("\n") if WORD.search(x)]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.n_covered) == (
            len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)),
            covered(8), covered(13)), t[:40]
        longest = max([n for n in range(8, len(w)) if covered(n)], default=0) if len(w) < 400 else r.longest_repeat
        assert r.longest_repeat == longest
        assert r.base_failed == (len(w) < 20 or 100 * covered(8) > 30 * len(w))
        assert not (r.kept and r.base_failed)
    assert quality_rules.filter_documents(docs).columns == docs.columns
    assert quality_rules.judge(empty).count() == 0


def test_suffix_order_and_prefixes():
    rng = np.random.default_rng(1)
    codes = rng.integers(0, 3, 200)
    order, ranks = quality_rules.suffix_order(codes, np.full(200, 200))
    assert [tuple(codes[i:]) for i in order] == sorted(tuple(codes[i:]) for i in range(200))
    a, b = order[:-1], order[1:]
    shared = [next((k for k in range(200) if max(x, y) + k >= 200 or codes[x + k] != codes[y + k])) for x, y in
              zip(a, b, strict=True)]
    assert quality_rules.common_prefix(a, b, np.full(200, 200), ranks).tolist() == shared


def test_fm_index_counts_and_locates():
    rng = np.random.default_rng(2)
    text = rng.integers(1, 6, 3000)
    index = decontamination.FMIndex(text)
    for n in (1, 3, 7):
        phrase = text[100:100 + n]
        lo, hi = index.search(phrase[::-1][None, :], np.array([n]))
        found = sorted(index.locate(np.arange(lo[0], hi[0])).tolist())
        assert found == [i for i in range(3000 - n + 1) if (text[i:i + n] == phrase).all()]


@pytest.mark.parametrize("block_bytes", [1 << 22, 200])
def test_decontamination(spark, docs, empty, block_bytes):
    t = dict(ROWS)
    items = [(1, ROWS[10][1][30:260]), (2, "two words here"), (2, "two words here"), (3, None), (4, ""),
             (None, "déjà vu"), (5, ROWS[12][1])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    windows = {}
    for i, x in items:
        w = ALNUM.findall((x or "").translate(UP))
        for s in range(max(1, len(w) - 12)) if w else ():
            windows.setdefault(tuple(w[s:s + 13]), set()).add(i)
    got = decontamination.find_contamination(docs, bench, block_bytes=block_bytes).collect()
    assert len(got) == len(ROWS)
    for r in got:
        w = ALNUM.findall((r["_row"]["text"] or "").translate(UP))
        hit, seen = set(), set()
        for n in {len(k) for k in windows}:
            for s in range(len(w) - n + 1):
                found = windows.get(tuple(w[s:s + n]))
                if found:
                    seen |= found
                    hit.update(range(s, s + n))
        assert sorted(j for s in r.spans for j in range(s["start"], s["end"])) == sorted(hit)
        assert r.items == sorted(str(x) for x in seen if x is not None) and r.n_words == len(w)
    assert decontamination.find_contamination(empty, bench).count() == 0
    none = decontamination.find_contamination(docs, bench.limit(0))
    assert none.where("size(spans) > 0").count() == 0
    assert t


def test_line_dedup(docs, empty):
    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate(UP)

    holders = {}
    for i, t in ROWS:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 10:
                holders.setdefault(key(line), set()).add(i if i is not None else 1 << 62)
    for copies in (500_000, 3):
        got = line_dedup.drop_repeated_lines(docs, lines_per_copy=copies, keys_per_shard=2 if copies == 3 else 500_000)
        got = got.collect()
        assert len(got) == len(ROWS)
        for r in got:
            i, lines = r["_row"]["doc_id"], (r["_row"]["text"] or "").split("\n")
            i = i if i is not None else 1 << 62
            kept = [x for x in lines if len(key(x)) < 10 or len(holders[key(x)]) < 2 or min(holders[key(x)]) == i]
            assert (r.n_lines, r.n_dropped, r.kept_text) == (len(lines), len(lines) - len(kept), "\n".join(kept))
    assert line_dedup.dedup_documents(docs).columns == docs.columns
    assert line_dedup.drop_repeated_lines(empty).count() == 0


def test_perfect_hash_is_minimal():
    keys = np.random.default_rng(0).integers(0, 2**63, 5000).astype(np.uint64)
    own = line_dedup.PerfectHash(keys)
    assert sorted(own.number(keys).tolist()) == list(range(5000))
    again = line_dedup.PerfectHash.load(*own.dump())
    assert (again.number(keys) == own.number(keys)).all()


def test_substring_dedup(docs, empty):
    last = 1 << 62
    order = sorted({(i if i is not None else last, t or "") for i, t in ROWS},
                   key=lambda x: (x[0], 0))
    got = {}
    for r in substring_dedup.drop_repeated_passages(docs).collect():
        got.setdefault(r.doc_id, []).append(r)
    seen = set()
    for i, t in order:
        if i == 66:
            continue  # one id with two texts: their order is by hash
        w, gone = WORD.findall(t), set()
        for s in range(len(w) - 19):
            k = tuple(w[s:s + 20])
            if k in seen:
                gone.update(range(s, s + 20))
            seen.add(k)
        for r in got[i if i != last else None]:
            assert (r.n_words, r.n_removed) == (len(w), len(gone)), (i, t[:40])
            assert r.kept_text == " ".join(x for j, x in enumerate(w) if j not in gone)
    assert sum(map(len, got.values())) == len(ROWS)
    assert substring_dedup.drop_repeated_passages(empty).count() == 0


def shingles(t):
    w = WORD.findall((t or "").translate(UP))
    return {tuple(w[j:j + 5]) for j in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} if w else set()


def linked(x, y):
    both = len(x & y)
    return both > 0 and 100 * both >= 75 * len(x | y)


def components(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in range(len(rows)):
        for b in range(a):
            if linked(sets[a], sets[b]):
                root[find(a)] = find(b)
    low = {}
    for a, (i, _) in enumerate(rows):
        if i is not None:
            low[find(a)] = min(low.get(find(a), i), i)
    return [(i, len(sets[a]), i if not sets[a] else low.get(find(a), i)) for a, (i, _) in enumerate(rows)]


def test_jaccard_join(docs, empty):
    got = sorted([tuple(r)[:3] for r in jaccard_join.near_duplicates(docs).collect()], key=str)
    assert got == sorted(components(ROWS), key=str)
    assert jaccard_join.near_duplicates(empty).count() == 0
    assert jaccard_join.one_per_group(docs).columns == docs.columns


def test_jaccard_join_loses_no_link(spark):
    """A family of near copies around the threshold, and short texts that differ in one shingle."""
    rng = random.Random(5)
    bag = [f"v{i}" for i in range(4000)]
    rows = []
    for f in range(6):
        base = [rng.choice(bag) for _ in range(rng.choice((6, 9, 40, 150)))]
        for _ in range(30):
            w = list(base)
            for _ in range(rng.randrange(0, max(2, len(w) // 12))):
                w[rng.randrange(len(w))] = rng.choice(bag)
            rows.append((len(rows), " ".join(w[:rng.randrange(len(w) - 2, len(w) + 1)])))
    got = jaccard_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(tuple(r)[:3] for r in got) == sorted(components(rows))


@pytest.mark.parametrize("order", ["sampled", "none", "any"])
def test_jaccard_join_is_whole_whichever_shingles_are_counted(spark, monkeypatch, order):
    """Frequent shingles only come later in the order: counted in few texts, none known, or any with any count."""
    rng = random.Random(9)
    bag = [f"v{i}" for i in range(3000)]
    common = [rng.choice(bag) for _ in range(12)]
    rows = []
    for _ in range(8):
        base = [rng.choice(bag) for _ in range(rng.choice((7, 30, 90)))] + common
        for _ in range(25):
            w = list(base)
            for _ in range(rng.randrange(0, max(2, len(w) // 12))):
                w[rng.randrange(len(w))] = rng.choice(bag)
            rows.append((len(rows), " ".join(w)))
    rows += [(len(rows) + i, " ".join(common + [f"end{i}"] * (i % 4))) for i in range(40)]
    if order == "sampled":
        monkeypatch.setattr(jaccard_join, "SAMPLE_TEXTS", 8)
    else:
        known = np.unique(np.concatenate(jaccard_join.shingle_sets(pa.array([t for _, t in rows]))))
        known = known[:0] if order == "none" else np.random.default_rng(9).choice(known, len(known) // 2, replace=False)
        frequent = jaccard_join.Frequent(known, np.random.default_rng(8).integers(3, 99, len(known)))
        monkeypatch.setattr(jaccard_join, "frequent_shingles", lambda texts, count: frequent)
    got = jaccard_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(tuple(r)[:3] for r in got) == sorted(components(rows))


def test_sketch_distance_bounds_the_difference():
    rng = np.random.default_rng(4)
    pool = rng.integers(0, 2**63, 9000).astype(np.uint64)
    for n, m in ((100, 120), (900, 1400), (3000, 2500)):
        a, b = np.unique(rng.choice(pool, n)), np.unique(rng.choice(pool, m))
        apart = jaccard_join.hamming(jaccard_join.dense_sketch(a), jaccard_join.dense_sketch(b))
        assert apart <= len(np.setxor1d(a, b))
        x, y = (jaccard_join.coarse_sketch(jaccard_join.dense_sketch(s), len(s)) for s in (a, b))
        assert jaccard_join.hamming(x, y) <= apart


@pytest.mark.parametrize("shards,ranges", [(4, 2), (16, 8)])
def test_sharding(spark, docs, empty, shards, ranges):
    hot = [(7, "same text")] * 300 + [(i, "t" * (i % 50)) for i in range(600)] + [(None, None)] * 5
    df = spark.createDataFrame(hot, "doc_id long, text string")
    got = sharding.histogram_shards(df, shards, ranges_per_shard=ranges).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size, r.text_crc32) for r in got) == sorted(
        (i is None, i or 0, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in hot)
    total, largest = sum(r.size for r in got), max(r.size for r in got)
    for s in range(shards):
        own = [r for r in got if r.shard == s]
        assert sorted(r.slot for r in own) == list(range(len(own)))
        assert abs(sum(r.size for r in own) - total / shards) <= largest + 0.002 * total
    assert sharding.histogram_shards(docs, shards).count() == len(ROWS)
    assert sharding.histogram_shards(empty, shards).count() == 0


def plain_search(whole, own):
    """Ids by the search with all boundaries kept."""
    best = [(0, None, ())] + [None] * len(whole)
    for end in range(1, len(whole) + 1):
        for start in range(max(0, end - own.longest), end):
            got = own.score.get(whole[start:end])
            if got and (best[end] is None or best[start][0] + got[0] > best[end][0]):
                best[end] = (best[start][0] + got[0], start, (got[1],))
        if whole[end - 1] not in own.score:
            raw = whole[end - 1].encode()
            score = best[end - 1][0] + own.byte_score * len(raw)
            if best[end] is None or score > best[end][0]:
                best[end] = (score, end - 1, tuple(own.byte_ids[b] for b in raw))
    path, end = [], len(whole)
    while end:
        _, end, got = best[end]
        path.append(got)
    return [i for got in reversed(path) for i in got]


def test_pieces_round_trip_and_search(docs, empty):
    lanes = pieces.load(pieces.MODEL)
    own = lanes.pieces
    texts = [t for _, t in ROWS]  # whole texts
    ids, ends = pieces.encode_texts(pa.array(texts, pa.string()), lanes)
    for i, t in enumerate(texts):
        got = ids[ends[i]:ends[i + 1]].tolist()
        assert pieces.decode_ids(got, own) == (t or "")
        whole = " " + t if t else ""
        committed = []
        assert got == plain_search(whole, own) == own.viterbi(whole, committed)
        if len((t or "").split()) > 100:
            assert len(committed) > 5  # ids leave the window as the text is read
    got = pieces.encoded_documents(docs).collect()
    assert sorted(str(r.decoded_sha256) for r in got) == sorted(str(None if t is None else sha(t)) for _, t in ROWS)
    back = pieces.decode(pieces.encode(docs, keep=["doc_id"]), "ids").collect()
    assert sorted(str(r.decoded) for r in back) == sorted(str(t) for _, t in ROWS)
    assert pieces.encoded_documents(empty).count() == 0


def test_lanes_are_the_streaming_search():
    lanes = pieces.load(pieces.MODEL)
    rng = random.Random(9)
    parts = [*rng.sample(list(lanes.pieces.score), 300), "日本", "ж", "\U0001f600", "zq", "▁", "é", "#", "x"]
    words = {" " + "".join(rng.choice(parts) for _ in range(rng.randrange(1, 12))).replace(" ", "").replace("\n", "")[:rng.randrange(1, 200)]
             for _ in range(1500)} | {" ", "   ", "\n", " a", " " + "x" * 95, " " + "x" * 500, " " + "ab" * 45}
    words = sorted(words)
    commits = []
    ids, ends = pieces.encode_words(pa.array([w.encode() for w in words], pa.large_binary()), lanes, commits)
    for i, w in enumerate(words):
        assert ids[ends[i]:ends[i + 1]].tolist() == plain_search(w, lanes.pieces), w
    # short words commit at their end; longer ones also before, whenever the surviving paths have met
    short, early = commits[0]
    assert short == sum(len(w) < pieces.LANE for w in words) and early > 20
    none, at = pieces.encode_words(pa.array([], pa.large_binary()), lanes)
    assert len(none) == 0 and at.tolist() == [0]


def test_secret_scan(spark, empty):
    rng = random.Random(1)
    b64 = "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(44))
    texts = {
        1: 'PASSWORD = "hunter22"; api_key:abc', 2: "AKIA" + "A1" * 8 + " AKIAshort", 3: "x " + "0a" * 12 + " " + "0a" * 11,
        4: f"see {b64} here", 5: "id 123e4567-e89b-12d3-a456-426614174000 sha " + "0123456789abcdef" * 4,
        6: None, 7: "", 8: "perfectly ordinary international correspondence/without/any/secrets-whatsoever",
        9: f"token={b64}", 10: "paſſword=abcdefgh",
    }
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["_row"]["doc_id"]: [(s["kind"], s["start"], s["end"]) for s in r.spans]
           for r in secret_scan.find_secrets(df).collect()}
    assert got[1] == [("assign", 0, 20)] and got[2] == [("access", 0, 20)] and got[3] == [("hex", 2, 26)]
    assert got[4] == [("random", 4, 48)] and [k for k, _, _ in got[5]] == ["hex"]
    assert got[6] == got[7] == got[8] == got[10] == []
    assert [k for k, _, _ in got[9]] == ["assign"]
    assert secret_scan.find_secrets(empty).count() == 0


def test_url_filter(spark):
    link = '<link href="{}" rel="canonical">'
    meta = '<META content="0; URL={}" HTTP-EQUIV="refresh">'
    pages = [
        (1, "http://a.example.com/en/x", link.format("http://other.org/p")), (2, "https://other.org/p#frag", None),
        (3, "http://www.example.com/en/x", ""), (4, "http://EXAMPLE.com", None), (5, None, None), (6, "nohost", link.format("/z")),
        (7, "http://q.net/es/1", meta.format("//mirror.org/m")), (8, "http://mirror.org/m", meta.format("http://good.com/a")),
        (9, "http://notexample.com/en/", None), (10, "http://self.org/a", link.format("a")), (2, "https://other.org/p#frag", None),
    ]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict, r.by) for r in url_filter.filter_urls(df).collect()}
    assert got[1] == ("a.example.com", "/en/x", "example.com/en/", "block", "rule")
    assert got[2] == ("other.org", "/p", None, "block", "alias")
    assert got[3][2:4] == ("www.example.com/en/", "allow") and got[4][:3] == ("example.com", "", None)
    assert got[5] == got[6] == ("", "", None, "allow", "default")
    assert got[7][3] == "block" and got[8][2:] == (None, "allow", "alias")  # an allowed alias takes precedence
    assert got[9][2] == "com/" and got[10][2:] == (None, "allow", "default")
    assert url_filter.filter_urls(df.limit(0)).count() == 0


def test_url_targets_are_decoded_and_resolved_like_the_standard_library(spark):
    """Character references against html.unescape, references against urllib's, on random parts."""
    texts = ["a&amp;b", "&#38;&#x26;&#X2F;", "&amp;#38;", "&lt;&gt;&quot;&apos;", "&", "&&amp;", "x&nosuch;y", "&#8364;&#x1F600;",
             "&#0;&#xD800;&#x110000;", "", "plain", "&#65;&#066;&#x43;D", "a&#", "&#x;&#;"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", url_filter.unescaped(F.col("t")).alias("u"))
    assert {r.t: r.u for r in df.collect()} == {t: html.unescape(t) for t in texts}
    rng = random.Random(8)
    parts = ["a", "b", ".", "..", "c.d", "...", "x"]
    urls = ["http://h.org/" + "/".join(rng.choice(["a", "b", "c.d"]) for _ in range(rng.randrange(4))) for _ in range(40)]
    rows = []
    for url in urls:
        for _ in range(8):
            path = "/".join(rng.choice(parts) for _ in range(rng.randrange(1, 6)))
            rows.append((url, rng.choice(["", "/", "http://o.net/", "//p.com/", "?q=", "#"]) + path))
    df = spark.createDataFrame(rows, "u string, t string")
    got = df.select("u", "t", url_filter.url_node(url_filter.resolve(F.col("u"), F.col("t"))).alias("n")).collect()
    for r in got:
        # urllib resolves dots of relative references only: join twice, so that absolute ones are resolved too
        whole = urljoin(r.u, r.t)
        split = urlsplit(urljoin(whole, urlsplit(whole).path or "/"))
        query = urlsplit(whole).query
        assert r.n == split.netloc + split.path + ("?" + query if query else ""), (r.u, r.t, r.n)
    none = spark.createDataFrame([("http://h.org/a", t) for t in ("mailto:x@y", "javascript:go()", "data:text/html,x")], "u string, t string")
    assert none.select(url_filter.resolve(F.col("u"), F.col("t")).alias("x")).where("x is not null").count() == 0


def test_url_aliases_by_written_variants(spark):
    """Decisions travel over targets with character references, dot segments and bare queries; long URLs, clashing columns."""
    link, long = '<link rel="canonical" href="{}">', "http://blk.net/es/" + "d/../" * 3000 + "z"
    pages = [
        (1, "http://m.org/x/y/page", link.format("../../deep/./one"), "u"), (2, "http://m.org/deep/one", link.format("http://a.net/es/1"), "v"),
        (3, "http://n.org/s?a=1&b=2", None, "u"), (4, "http://b.net/fr/2", link.format("http://n.org/s?a=1&amp;b=2"), "v"),
        (5, "http://q.org/list", link.format("?page=2"), "u"), (6, "http://q.org/list?page=2", link.format("http:&#x2F;&#47;c.net/es/"), None),
        (7, long, link.format("//tail.org/t"), None), (8, "http://tail.org/t", None, None), (9, "http://tail.org/%74", None, None),
        (10, "http://r.org/a", link.format("#top"), None), (None, None, None, None),
    ]
    df = spark.createDataFrame(pages, "page_id long, url string, html string, node string").withColumn("root", F.lit(1)).withColumn(
        "host", F.lit("x")).withColumn("u", F.lit("y"))
    got = {r.page_id: (r.verdict, r.by) for r in url_filter.filter_urls(df).collect()}
    assert [got[i] for i in (1, 2, 3, 5, 6, 8)] == [("block", "alias")] * 6
    assert got[4] == got[7] == ("block", "rule") and got[9] == got[10] == got[None] == ("allow", "default")


def test_connected_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(5, 5), (None, 3)]
    root = {}

    def find(a):
        root.setdefault(a, a)
        while root[a] != a:
            a = root[a]
        return a

    for a, b in edges:
        if a is not None and a != b:
            a, b = sorted((find(a), find(b)))
            root[b] = a
    got = C.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.root for r in got} == {a: find(a) for a in list(root)} and len(got) == len(root)


def test_attention_model_gradient_and_windows():
    shape = A.Shape(classes=4, members=3, width=3, window=4, overlap=1)
    w = {k: v.astype(np.float64) for k, v in shape.start().items()}
    rng = np.random.default_rng(0)
    x, y, c = rng.integers(0, shape.begin + 1, (3, 4)), rng.integers(0, shape.end + 1, (3, 4)), rng.random((3, 4)) < 0.8

    def loss():
        h = A.attend(w, shape, x)[-1]
        total = 0
        for place in np.flatnonzero(c.ravel()):
            of, member = divmod(int(y.ravel()[place]), shape.members)
            logits = h[place] @ w["out"] + w["bias"]
            total -= logits[of] - math.log(np.exp(logits).sum())
            if of < shape.classes - 1:
                logits = h[place] @ w["own"][of] + w["own_bias"][of]
                total -= logits[member] - math.log(np.exp(logits).sum())
        return total / c.sum()

    g = A.gradient(w, shape, x, y, c)
    for n in w:
        at = tuple(rng.integers(0, s) for s in w[n].shape)
        keep = w[n][at]
        w[n][at] = keep + 1e-5
        up = loss()
        w[n][at] = keep - 1e-5
        assert abs((up - loss()) / 2e-5 - g[n][at]) < 1e-5, n
        w[n][at] = keep
    lengths = np.array([1, 16, 17, 0, 40])
    first, end, skip = A.windows(lengths, 16, 4)
    scored = [p for f, e, s in zip(first, end, skip, strict=True) for p in range(f + s, min(f + 16, e))]
    assert sorted(scored) == list(range(lengths.sum()))


def test_lm_scoring(docs, empty):
    got = lm_scoring.score_documents(docs, rounds=2).collect()
    count, n = {}, 0
    for i, t in ROWS:
        if zlib.crc32(("" if i is None else str(i)).encode()) % 5 != 1:
            for w in [*WORD.findall((t or "").translate(UP)), None]:
                count[w] = count.get(w, 0) + 1
                n += 1
    want = []
    for i, t in ROWS:
        w = [*WORD.findall((t or "").translate(UP)), None]
        want.append((str(i), len(w), sum(x in count for x in w), n, round(sum(
            math.log10((count.get(x, 0) + 0.5) / (n + 0.5 * (len(count) + 1))) for x in w), 4)))
    assert sorted((str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got) == sorted(want)
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)
    assert lm_scoring.score_documents(empty).count() == 0
