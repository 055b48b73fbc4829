"""Operators 7 and 10 against plain brute force."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from edge import TEXTS, documents, edge_docs, empty_docs
from pyspark.sql import functions as F

from raw2clean.llm import components
from raw2clean.llm import op07_line_dedup as o7
from raw2clean.llm import op10_ngram_jaccard as o10
from raw2clean.llm.components import connected_components

ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SMALLEST = -(1 << 63)


def kept_lines(rows, min_chars=20, at_least=3):
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(ASCII)
    found, holder = Counter(), {}
    for i, t in rows:
        for k in {key(x) for x in (t or "").split("\n")}:
            if len(k) >= min_chars:
                found[k] += 1
                holder[k] = max(holder.get(k, SMALLEST), SMALLEST if i is None else i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (found[key(x)] >= at_least and holder[key(x)] != (SMALLEST if i is None else i))]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def lines_of(df, **kw):
    return sorted(((r.row.doc_id, r.n_lines, r.n_dropped, r.kept) for r in o7.dedup_lines(df, **kw).collect()), key=repr)


@pytest.mark.parametrize("batches", [1, 2, 5])
def test_line_dedup(spark, batches):
    rnd = random.Random(batches)
    pool = [f"Line number {i} of the pool, long enough" for i in range(12)] + ["short", "", "  Line number 3 of the pool, long ENOUGH\t", "né" * 12]
    texts = ["\n".join(rnd.choice(pool) for _ in range(rnd.randint(0, 6))) for _ in range(60)] + [None, ""]
    df = documents(spark, texts)
    assert lines_of(df, batches=batches) == kept_lines(list(enumerate(texts)))


def test_line_dedup_odd_cases(spark):
    assert lines_of(edge_docs(spark)) == kept_lines([(i, t) for i, t, _ in TEXTS])
    out = o7.dedup_lines(edge_docs(spark))
    assert out.schema["row"].dataType.names == edge_docs(spark).columns
    assert o7.dedup_lines(empty_docs(spark)).count() == 0
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("line_runs_")]


def brute_components(rows, width=4, percent=85):
    sets = []
    for _, t in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(ASCII))
        sets.append({tuple(words[k:k + width]) for k in range(len(words) - width + 1)} if len(words) >= width else {tuple(words)} - {()})
    label = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for a in range(len(rows)):
            for b in range(a):
                both = len(sets[a] & sets[b])
                if sets[a] and sets[b] and 100 * both >= percent * len(sets[a] | sets[b]) and label[a] != label[b]:
                    label[a] = label[b] = min(label[a], label[b])
                    changed = True
    ids = defaultdict(list)
    for k, (i, _) in enumerate(rows):
        if i is not None:
            ids[label[k]].append(i)
    return sorted(((i, len(sets[k]), i if not sets[k] else min(ids[label[k]], default=None)) for k, (i, _) in enumerate(rows)), key=repr)


def near_copies(seed, n):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    bases = [[rnd.choice(words) for _ in range(rnd.choice((3, 8, 30, 80, 200)))] for _ in range(n // 6)]
    out = []
    for _ in range(n):
        t = list(rnd.choice(bases))
        for _ in range(rnd.choice((0, 0, 1, 2, 4))):
            t[rnd.randrange(len(t))] = rnd.choice(words)
        out.append(" ".join(t[:len(t) - rnd.choice((0, 0, 1))]))
    return out


def components_of(df, **kw):
    return sorted((tuple(r) for r in o10.link_documents(df, **kw).collect()), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_ngram_join(spark, seed):
    texts = near_copies(seed, 150) + ["", None, "Same Few", "same few", "a  b\tc", "a b c", "a b c d", "a b c d d"]
    assert components_of(documents(spark, texts)) == brute_components(list(enumerate(texts)))


def test_ngram_join_in_many_parts(spark, monkeypatch):
    """Large components are cut into parts; those that the first blocks leave apart are cut anew."""
    monkeypatch.setattr(o10, "PART_SETS", 4)
    monkeypatch.setattr(o10, "SLICE", 16)
    texts = near_copies(7, 120)
    assert components_of(documents(spark, texts)) == brute_components(list(enumerate(texts)))


def test_ngram_join_of_components_that_stay_apart(spark, monkeypatch):
    """Candidates that hang together without linking: groups of many sets and of few, linked through sets of other parts."""
    asked = []
    blocks = o10._open_blocks
    monkeypatch.setattr(o10, "_open_blocks", lambda rest: asked.append(1) or blocks(rest))
    monkeypatch.setattr(o10, "PART_SETS", 3)
    rnd, base, texts = random.Random(5), [f"b{i}" for i in range(120)], []
    for group, size in ((0, 30), (1, 20), (2, 2), (3, 1), (4, 1)):
        for k in range(size):
            t = list(base)
            for at in range(group * 2):               # ever farther from the first group
                t[at * 12 + group] = f"g{group}x{at}"
            t[rnd.randrange(120)] = f"own{group}x{k}"
            texts.append(" ".join(t))
    got = components_of(documents(spark, texts))
    assert got == brute_components(list(enumerate(texts))) and len({c for _, _, c in got}) > 1
    assert asked


def test_blocks_grow_as_the_copies_do(spark, monkeypatch):
    """A group of many near copies hangs together by the blocks of neighbouring parts: no pair of parts beyond them."""
    monkeypatch.setattr(o10, "_open_blocks", lambda rest: pytest.fail("parts paired"))
    monkeypatch.setattr(o10, "PART_SETS", 16)
    base = [f"b{i}" for i in range(200)]
    texts = [" ".join([*base[:k % 200], f"own{k}", *base[k % 200 + 1:]]) for k in range(1000)]
    assert {c for _, _, c in components_of(documents(spark, texts))} == {0}


def test_ngram_join_odd_cases(spark):
    assert components_of(edge_docs(spark)) == brute_components([(i, t) for i, t, _ in TEXTS])
    assert components_of(empty_docs(spark)) == []


def test_blocked_product_is_the_plain_one():
    rng = np.random.default_rng(3)
    base = rng.integers(1, 1 << 60, 400).astype(np.uint64)
    sets = [np.unique(np.concatenate([rng.choice(base, 300, replace=False), rng.integers(1, 1 << 60, 5).astype(np.uint64)])) for _ in range(20)]
    sets += [np.unique(np.concatenate([sets[0][:-9], sets[0][-8:]])), sets[1][:290], base[:3]]
    part = np.arange(len(sets)) % 2
    for p in (np.zeros(len(sets), int), part):
        got = o10.linked_pairs(sets, p, 60)
        for a in range(len(sets)):
            for b in range(len(sets)):
                both = len(np.intersect1d(sets[a], sets[b]))
                want = a != b and (p.max() == 0 or p[a] != p[b]) and 100 * both >= 60 * (len(sets[a]) + len(sets[b]) - both)
                assert got[a, b] == want


@pytest.mark.parametrize("percent", [50, 85, 97])
def test_sets_that_link_share_a_signature(percent):
    """Also where most n-grams are frequent ones, and where sets are small."""
    rnd, rng = random.Random(percent), np.random.default_rng(percent)
    frequent = np.sort(rng.integers(1, 1 << 63, 300).astype(np.uint64))
    parts = o10.Parts(frequent, percent)
    for _ in range(1500):
        n = rnd.choice((5, 8, 13, 40, 120, 400))
        a = np.unique(np.concatenate([rng.choice(frequent, min(300, int(n * rnd.random()))), rng.integers(1, 1 << 63, n).astype(np.uint64)]))
        drop = rnd.randint(0, max(1, len(a) * (100 - percent) // 100))
        b = np.unique(np.concatenate([np.delete(a, rng.choice(len(a), min(drop, len(a) - 1), replace=False)), rng.integers(1, 1 << 63, rnd.choice((0, 0, 1, drop // 2))).astype(np.uint64)]))
        both = len(np.intersect1d(a, b))
        if not np.array_equal(a, b) and 100 * both >= percent * (len(a) + len(b) - both):
            signatures, of = parts.signatures([a, b])
            assert np.intersect1d(signatures[of == 0], signatures[of == 1]).size, (len(a), len(b), both)


def test_size_classes():
    for percent in (50, 85, 100):
        borders = o10.size_classes(percent, 5000)
        assert all(x < y for x, y in zip(borders, borders[1:], strict=False))
        differ, parts = o10.window_parts(percent, borders)
        at = lambda n: int(np.searchsorted(borders, n, side="right")) - 1
        for n in range(1, 3000, 7):
            most = 100 * n // percent
            assert at(most) <= at(n) + 1
            assert (n + most) * (100 - percent) // (100 + percent) <= differ[at(n)] < parts[at(n)]


def test_ties():
    signatures, sets = np.array([5, 5, 9, 5, 9, 1], np.uint64), np.array([4, 2, 7, 2, 4, 1])
    s, first, ties = o10.tie(signatures, sets)
    assert s.tolist() == [1, 5, 9] and first.tolist() == [1, 2, 4] and ties.tolist() == [[2, 4], [4, 7]]
    assert [x.tolist() for x in o10.tie(signatures[:0], sets[:0])] == [[], [], []]
    chain = np.array([[i, i + 1] for i in range(9, 40)] + [[3, 50], [50, 4]])
    assert o10.forest_of(chain).tolist() == [[3, 4], *[[9, i] for i in range(10, 41)], [3, 50]]
    assert o10.forest_of(np.zeros((0, 2), np.int64)).shape == (0, 2)


@pytest.mark.parametrize("held", [1, 500])
def test_ngram_join_of_many_flushes(spark, monkeypatch, held):
    monkeypatch.setattr(o10, "HELD", held)
    texts = near_copies(11, 150)
    assert components_of(documents(spark, texts).repartition(6)) == brute_components(list(enumerate(texts)))


@pytest.mark.parametrize("hub", [components.HUB_EDGES, 5])
def test_connected_components(spark, monkeypatch, hub):
    monkeypatch.setattr(components, "HUB_EDGES", hub)
    rnd = random.Random(4)
    edges = [(i, i + 1) for i in range(60)] + [(100, k) for k in range(101, 140)] + [(rnd.randint(200, 400), rnd.randint(200, 400)) for _ in range(90)] + [(500, 500)]
    label = {x: x for e in edges for x in e}
    while any(label[a] != label[b] for a, b in edges):
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    got = {r.node: r.label for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {k: v for k, v in label.items() if k != 500}
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_a_node_of_many_edges_is_not_shuffled_to_its_minimum(spark, monkeypatch):
    """Its edges stay where they lie: after the join no partition holds more than its share."""
    monkeypatch.setattr(components, "HUB_EDGES", 1000)
    edges = spark.range(0, 40_000, 1, 8).select(F.lit(7).cast("long").alias("u"), (F.col("id") + 100).alias("v"))
    met = components._with_least(edges, 40_000)
    sizes = [r["n"] for r in met.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == 40_000 and max(sizes) <= 10_000
    assert met.where("m <> 100").isEmpty()


def test_hashes_of_words_do_not_depend_on_their_place():
    from raw2clean.llm.common import span_hashes, text_buffer, word_spans
    import pyarrow as pa
    texts = ["alpha beta", "", "beta  alpha", "betaalpha"]
    data, offsets = text_buffer(pa.array(texts))
    starts, ends, row = word_spans(data != 32, offsets)
    h = span_hashes(data, starts, ends).tolist()
    assert row.tolist() == [0, 0, 2, 2, 3] and h[0] == h[3] and h[1] == h[2] and len({h[0], h[1], h[4]}) == 3


def test_packed_numbers_shrink_and_come_back():
    import zlib
    r = np.random.default_rng(3)
    for values in (np.sort(r.integers(0, 1 << 64, 4_000, np.uint64, endpoint=False)), np.zeros(0, np.uint64), np.array([(1 << 64) - 1], np.uint64)):
        assert np.array_equal(np.cumsum(o10.unpacked(o10.packed(np.diff(values, prepend=np.uint64(0))), np.uint64), dtype=np.uint64), values)
    uids = (5 << 36) + r.integers(0, 8_000, 4_000)
    assert np.array_equal(o10.unpacked(o10.packed(uids), np.int64), uids)
    assert len(zlib.compress(o10.packed(uids), 1)) < 0.8 * len(zlib.compress(uids.tobytes(), 1))
