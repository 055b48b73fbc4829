"""Operators 4, 6 and 9 against plain brute force, and the registered SQL."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from edge import TEXTS, documents, edge_docs, empty_docs
from pyspark.sql import functions as F

from raw2clean.llm import op04_topk as o4
from raw2clean.llm import op06_mixing as o6
from raw2clean.llm import op09_url_filter as o9


def best(rows, k=5, every=50):
    data = []
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            data.append((i, [math.floor(256 * float(x)) if abs(x) < 2 ** 44 else int(256 * float(x)) for x in v]))
    out = []
    for q, qv in {(i, tuple(v)) for i, v in data if i % every == 0}:
        score = lambda v: max(-1 << 63, min((1 << 63) - 1, sum(a * b for a, b in zip(qv, v, strict=True))))  # noqa: B023, E731
        found = sorted((-score(v), i) for i, v in data if i != q and len(v) == len(qv))
        out += [(q, r, i, -s) for r, (s, i) in enumerate(found[:k], 1)]
    return sorted(out)


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1.0) for i, v in rows], "vec_id long, embedding array<double>, block string, score double")


@pytest.mark.parametrize(("pivots", "block"), [(1, 10_000), (7, 5), (64, 16)])
def test_top_k(spark, pivots, block):
    rng = np.random.default_rng(pivots)
    centres = rng.normal(size=(6, 8))
    rows = [(i, (centres[i % 6] * 2 + rng.normal(size=8) * 0.1).tolist()) for i in range(700)]
    rows += [(700 + i, rows[3][1]) for i in range(40)] + [(800 + i, [0.0] * 8) for i in range(60)] + [(900, [1.0, 2.0]), (901, [1.0, 3.0]), (950, [])]
    got = sorted(tuple(r) for r in o4.top_k(vectors(spark, rows), n_pivots=pivots, block=block).collect())
    assert got == best(rows)


def test_top_k_odd_cases(spark):
    rows = [(0, [1.0, float("nan")]), (50, None), (100, [1.0, None]), (150, [0.5, 0.25]), (150, [0.5, 0.25]), (151, [0.5, 0.25]), (None, [1.0, 1.0]),
            (200, [float("inf"), 1.0]), (152, [-0.001, 0.0]), (250, [1e300, 1.0]), (153, [1e300, -1.0]), (154, [-1e300, 1.0]), (-50, [2.0, 2.0])]
    got = sorted(tuple(r) for r in o4.top_k(vectors(spark, rows)).collect())
    assert got == best(rows) and {r[0] for r in got} == {150, 250, -50}
    assert o4.top_k(vectors(spark, [])).count() == 0
    assert o4.top_k(vectors(spark, [(50, [1.0])])).count() == 0


@pytest.mark.parametrize("times", [2, 8])
@pytest.mark.parametrize(("pivots", "block"), [(1, 10_000), (64, 16)])
def test_top_k_of_a_repeated_query_id(spark, times, pivots, block):
    """Rows under a query's id, equal ones and others, take no place from rows of other ids."""
    rng = np.random.default_rng(times)
    centres = rng.normal(size=(6, 8))
    rows = [(i, (centres[i % 6] * 2 + rng.normal(size=8) * 0.1).tolist()) for i in range(700)]
    for i in (50, 100, 150):   # long vectors: their own copies score best
        rows[i] = (i, (np.array(rows[i][1]) * 3).tolist())
    rows += [(50, rows[50][1])] * (times - 1) + [(i, rows[50][1]) for i in (1051, 1052, 1053, 1054, 1055)]   # equal rows of the id
    rows += [(100, (np.array(rows[100][1]) * (1 + j / 50)).tolist()) for j in range(1, times)]               # other vectors under the id
    rows += [(250, rows[150][1])] * (times - 1) + [(1151, rows[150][1])] * 7                                 # two query ids and a repeated candidate
    got = sorted(tuple(r) for r in o4.top_k(vectors(spark, rows), n_pivots=pivots, block=block).collect())
    assert got == best(rows)


def words(t):
    return len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))


def test_targets():
    assert o6.targets([100, 100, 100], [1, 1, 2]) == [75, 75, 150]
    assert o6.targets([10, 100, 1000], [5, 2, 1]) == [30, 300, 780]
    assert o6.targets([0, 10], [5, 1]) == [0, 10] and o6.targets([0, 0], [5, 1]) == [0, 0] and o6.targets([], []) == []
    rnd = random.Random(1)
    for _ in range(100):
        s = [rnd.choice((0, rnd.randint(1, 10 ** rnd.randint(1, 6)))) for _ in range(rnd.randint(1, 30))]
        w = [o6.WEIGHTS[i % 3] for i in range(len(s))]
        t = o6.targets(s, w)
        assert all(a <= 3 * b for a, b in zip(t, s, strict=True)) and abs(sum(t) - sum(s)) <= 1e-9 * sum(s) + 1e-9
        free = [a / b for a, b, c in zip(t, w, s, strict=True) if a < 3 * c]
        assert not free or max(free) - min(free) <= 1e-9 * max(free)


def test_splitting_tree_keeps_quotas():
    q = [1000, 0, 3, 256, 77]
    out = o6.split_quotas(q, 7)
    assert out.sum(axis=0).tolist() == q and out.min() >= 0 and np.ptp(out.sum(axis=1)) <= 3
    assert (out == o6.split_quotas(q, 7)).all()


@pytest.mark.parametrize("few", [4, 64])
def test_mix(spark, monkeypatch, few):
    monkeypatch.setattr(o6, "FEW", few)
    rnd = random.Random(few)
    rows = [(i, " ".join("w" for _ in range(rnd.choice((0, 5, 50, 400)))), "en", rnd.choices(["a", "b", "c", None], [20, 3, 3, 1])[0], 0) for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    plan = o6.plan_mix(docs)
    got = {r.doc_id: r for r in o6.taken(plan).collect()}
    size = {}
    for i, t, _, s, _ in rows:
        size[s] = size.get(s, 0) + words(t)
        assert got[i].size == words(t) and got[i].taken % max(words(t), 1) == 0 and got[i].taken <= 3 * words(t)
    order = sorted(size, key=lambda s: (s is None, s or ""))
    goal = dict(zip(order, o6.targets([size[s] for s in order], [o6.WEIGHTS[i % 3] for i in range(len(order))]), strict=True))
    for s in order:
        of = [got[r[0]] for r in rows if r[3] == s]
        assert {(g.source_size, g.target) for g in of} == {(size[s], goal[s])}
        assert abs(sum(g.taken for g in of) - goal[s]) <= (200 if few == 4 else 5 + 0.002 * goal[s])   # half a document, or an exchange of two
    again = {r.doc_id: (r.taken, r.shards) for r in o6.taken(o6.plan_mix(docs.repartition(3))).collect()}
    assert again == {i: (g.taken, g.shards) for i, g in got.items()}
    mix = o6.mixed(docs, plan)
    assert mix.columns == docs.columns
    times = {r.doc_id: r["count"] for r in mix.groupBy("doc_id").count().collect()}
    assert times == {i: len(g.shards) for i, g in got.items() if g.shards}


def test_mix_odd_cases(spark):
    docs = edge_docs(spark)
    plan = o6.plan_mix(docs)
    out = o6.taken(plan).collect()
    assert len(out) == len(TEXTS) and sum(r.size for r in out) == sum(words(t) for _, t, _ in TEXTS)
    assert o6.mixed(docs, plan).columns == docs.columns
    assert o6.taken(o6.plan_mix(empty_docs(spark))).count() == 0
    blank = documents(spark, ["", None, " "])
    assert {(r.size, r.target, r.taken) for r in o6.taken(o6.plan_mix(blank)).collect()} == {(0, 0.0, 0)}


URLS = [None, "", "no scheme", "http://", "http://Example.ORG", "http://example.org/", "https://a.Example.org/es/x?y#z", "http://example.org/ES/1", "x://example.org/en/1",
        "http://example.org/en/12/3", "http://example.org/en/21", "http://notexample.org/es/", "http://org/es/", "http://com/fr/", "http://x.com/de/?q", "http://x.com/de",
        "http://x.com/fr/1", "http://u:p@x.com:80/fr/", "http://x.com:80/fr/", "http://a.net/casino/1", "http://casino.org/x", "http://a.net/casinos", "a://b://c.com/de/", "http://x.com#/de/",
        "http://casino.com/fr/1", "http://a.net/\n/spam"]


def brute_judge(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (m[1].translate(str.maketrans(o9.UPPER, o9.LOWER)), m[2]) if m else ("", "")
    fits = [(len(t), v == "block", t, v) for v, t in o9.RULES for h, s, p in [t.partition("/")]
            if (host == h or host.endswith("." + h)) and path.startswith(s + p)]
    if fits:
        return host, path, max(fits)[2], max(fits)[3]
    bad = any(re.search(rf"(?i)(?<![a-z0-9]){w}(?![a-z0-9])", host + path) for _, w in o9.WORDS)
    return host, path, None, "block" if bad else "allow"


def test_url_rules(spark):
    rows = [(k if k != 3 else None, u, "h", "v") for k, u in enumerate(URLS)] * 2
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, verdict string")
    got = sorted((tuple(r) for r in o9.judge_urls(pages, o9.production_rules(spark)).collect()), key=repr)
    assert got == sorted(((i, *brute_judge(u)) for i, u, _, _ in rows), key=repr)
    assert o9.judge_urls(pages.limit(0), o9.production_rules(spark)).count() == 0
    assert {r.verdict for r in o9.judge_urls(pages, o9.production_rules(spark).limit(0)).collect()} == {"allow"}


def test_many_url_rules(spark):
    """A table of 50,000 rules beside odd ones; a url of 200,000 letters."""
    odd = [("host", "block", "a.b-c.net"), ("host", "allow", "A.B-C.net"), ("host", "block", "net/x+y(1)/"), ("host", "allow", "/only/path"),
           ("word", "block", "c++"), ("word", "allow", None), ("other", "block", "net"), ("host", "block", "a.b-c.net"), ("host", "allow", "é.org/ü")]
    many = spark.range(50_000).select(F.lit("host").alias("kind"), F.lit("block").alias("verdict"), F.concat(F.lit("h"), "id", F.lit(".com/p")).alias("rule"))
    rules = many.unionByName(spark.createDataFrame(odd, "kind string, verdict string, rule string"))
    long = "http://h9.com/p" + "/segment" * 25_000
    urls = {"http://h49999.com/page": ("h49999.com/p", "block"), "http://x.h7.com/p": ("h7.com/p", "block"), "http://h7.com/q": (None, "allow"),
            "http://h70.community/p": (None, "allow"), long: ("h9.com/p", "block"), "http://a.b-c.net": ("a.b-c.net", "block"),
            "http://z.A.B-c.net/x+y(1)/2": ("net/x+y(1)/", "block"), "http://a.b-c.network/": (None, "allow"), "http://aXb-c.net/": (None, "allow"),
            "http:///only/path/1": ("/only/path", "allow"), "http://q/c++": (None, "block"), "http://q/cc": (None, "allow"),
            "http://é.org/über": ("é.org/ü", "allow"), None: (None, "allow"), "": (None, "allow")}
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: (r.rule, r.verdict) for r in o9.judge_urls(pages, rules).collect()}
    assert got == dict(enumerate(urls.values()))


def test_native_operators_run_no_python(spark):
    from raw2clean.llm.op07_line_dedup import dedup_lines
    pages = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    for df in (o9.judge_urls(pages, o9.production_rules(spark)), dedup_lines(documents(spark, ["a"]))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)


def test_fill_finds_the_nearest_sum():
    rnd = random.Random(2)
    for _ in range(60):
        docs = [(p, rnd.choice([0, 1, 3, 10, 50, rnd.randint(1, 400)])) for p in rnd.sample(range(1000), rnd.randint(0, 11))]
        rest = rnd.randint(1, 900)
        sums = {0}
        for _, s in docs:
            sums |= {x + s for x in sums}
        size = dict(docs)
        got = o6._fill(docs, rest)
        assert len(set(got)) == len(got)
        assert abs(sum(size[p] for p in got) - rest) == min(abs(x - rest) for x in sums)


@pytest.mark.parametrize(("n", "few"), [(40, 256), (900, 256), (900, 4), (900, 1)])
def test_the_mix_is_what_the_leaves_drew(spark, monkeypatch, n, few):
    """Whole blocks in the drawn order, each to one shard a copy, and one part: near the target by less than any plain cut's document."""
    monkeypatch.setattr(o6, "FEW", few)
    rnd = random.Random(n + few)
    rows = [(i, " ".join(["w"] * rnd.randint(1, 40)), "en", rnd.choice("aab") if i % 3 else "c", 0) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    plan = o6.plan_mix(docs, shards=5)
    out = o6.taken(plan).collect()
    of = {r[0]: r[3] for r in rows}
    for source in "abc":
        own = [r for r in out if of[r.doc_id] == source]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 1 + (few < 256) * 40
        assert all(r.taken in (0, r.size, 2 * r.size, 3 * r.size) and r.taken == r.size * len(r.shards) for r in own)
    blocks = plan.blocks.collect()
    quotas = Counter(s for b in blocks for s in [*b.shards, *([b.rest_shard] if b.rest_shard is not None else [])])
    assert max(quotas.values()) - min(quotas[s] for s in range(5)) <= 1      # leaves of equal capacity
    for no in {b.no for b in blocks}:
        whole = [b.block for b in blocks if b.no == no and b.rest_shard is not None and b.cut is None]
        assert set(whole) == set(o6.block_order(no)[:len(whole)])
