"""Operators 2, 3 and 8 against the libraries and plain brute force."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
import tiktoken
from edge import TEXTS, edge_docs, empty_docs
from hypothesis import given, settings
from hypothesis import strategies as st

from raw2clean.llm import op02_token_counts as o2
from raw2clean.llm import op03_byte_bpe as o3
from raw2clean.llm import op08_fingerprints as o8

MODEL, RANKS = public_tokenizers.path(o2.TOKENIZER), public_tokenizers.path(o3.RANKS)


@pytest.fixture(scope="module")
def pieces():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def encoding():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=o3.load_ranks(RANKS), special_tokens={})


def by_row(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_token_counts_match_the_library(spark, pieces):
    want = [(i, len((t or "").encode()), n := len(pieces.encode(t or "")), n > o2.LIMIT) for i, t, _ in TEXTS]
    assert by_row(o2.count_tokens(edge_docs(spark), MODEL)) == sorted(want, key=repr)
    assert o2.count_tokens(edge_docs(spark), MODEL, table_size=3).count() == len(TEXTS)
    assert o2.count_tokens(empty_docs(spark), MODEL).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from([*"ab\n\t ▁é漢.<s>0x", "</s>", "<0x0A>"]), max_size=40).map("".join))
def test_lengths_add_up_over_pre_tokens(text):
    lengths = o2.lengths_of(MODEL)
    assert sum(lengths.of(o2.pre_tokens(text)) if text else []) == len(lengths.sp.encode(text))


def test_misra_gries_keeps_what_is_frequent():
    from collections import Counter
    counts = Counter({f"w{i}": 1 for i in range(100)}) + Counter({"often": 50})
    assert o2.pruned(counts, 10)["often"] >= 50 - 150 // 11 and len(o2.pruned(counts, 10)) <= 10


def test_byte_bpe_round_trip(spark, encoding):
    def row(i, t):
        ids = encoding.encode_ordinary(t or "")
        return (i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())
    assert by_row(o3.round_trip(edge_docs(spark), RANKS, public_tokenizers.PATTERN)) == sorted((row(i, t) for i, t, _ in TEXTS), key=repr)
    assert o3.round_trip(empty_docs(spark), RANKS, public_tokenizers.PATTERN).count() == 0
    both = o3.decode_documents(o3.encode_documents(edge_docs(spark), RANKS, public_tokenizers.PATTERN), RANKS, public_tokenizers.PATTERN)
    assert by_row(both.selectExpr("doc_id", "cast(octet_length(ids) div 4 as long)", "sha2(ids, 256)", "sha2(decoded, 256)")) == sorted((row(i, t) for i, t, _ in TEXTS), key=repr)


@pytest.mark.parametrize("alphabet", ["a", "ab", "the ing", "aeiou", "0123456789", "é漢"])
def test_tree_joins_give_the_encoding(encoding, alphabet):
    pairs, rnd = o3.BytePairs(o3.load_ranks(RANKS)), random.Random(5)
    for n in (1, 2, 31, 32, 33, 64, 65, 200, 1500):
        data = "".join(rnd.choice(alphabet) for _ in range(n)).encode()
        want = encoding._encode_single_piece(data)
        assert pairs.encode(data) == want and pairs.merge(data) == want
        assert pairs.join(pairs.encode(data[:n // 3]), pairs.encode(data[n // 3:])) == want
        assert pairs.decode(want) == data


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


@settings(max_examples=300, deadline=None)
@given(st.text("abc", max_size=80), st.text("abc", max_size=80))
def test_edit_distance(a, b):
    assert o8.edit_distance(a, b) == levenshtein(a, b)


def test_rolling_hash_sees_seven_bytes():
    data = np.frombuffer(random.Random(1).randbytes(500), np.uint8)
    h = o8.rolling(data)
    assert all(o8.rolling(data[i - 6:i + 1])[-1] == h[i] for i in range(6, 500))


def test_likeness_of_edits():
    rnd = random.Random(2)
    words = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 9))) for _ in range(4000)]
    one, other = " ".join(words[:2000]), " ".join(words[2000:])
    changed = " ".join(words[:900] + ["changed"] + words[901:2000])
    assert o8.likeness(o8.fingerprint(one), o8.fingerprint(one)) == 1.0
    assert o8.likeness(o8.fingerprint(one), o8.fingerprint(changed)) > 0.9
    assert o8.likeness(o8.fingerprint(one), o8.fingerprint(o8.edited(one, other))) > 0.5
    assert o8.likeness(o8.fingerprint(one), o8.fingerprint(other)) < 0.25     # letters that fall together by chance
    assert o8.likeness(o8.fingerprint(""), o8.fingerprint("")) == 1.0 and o8.likeness(o8.fingerprint(""), o8.fingerprint(one)) == 0.0


def test_likeness_of_edits_of_short_texts():
    """Texts of 8 to 30 characters: any chunk that the edit leaves counts."""
    rnd, edits, unlike = random.Random(5), [], []
    for _ in range(600):
        one, other = ("".join(rnd.choice("abcdefghij ") for _ in range(n)) for n in (rnd.randint(8, 30), 30))
        a, b = o8.fingerprint(one), o8.fingerprint(o8.edited(one, other))
        (x, _), (y, _) = a.split(":")[1:], b.split(":")[1:]
        edits.append(o8.likeness(a, b))
        unlike.append(o8.likeness(a, o8.fingerprint(other)))
        assert x[0] != y[0] or edits[-1] > 0, (one, other)
    assert sum(edits) / len(edits) > 0.4 > 4 * sum(unlike) / len(unlike)


@pytest.mark.parametrize("partitions", [1, 3, 40])
def test_fingerprints_meet_the_next_document(spark, partitions):
    rows = sorted(((i, t or "") for i, t, _ in TEXTS), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
    want = []
    for (i, t), (_, n) in zip(rows, rows[1:] + rows[:1], strict=True):
        e = o8.edited(t, n)
        p, q, f = o8.fingerprint(t), o8.fingerprint(e), o8.fingerprint(n)
        want.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), p, q, o8.likeness(p, q), o8.likeness(p, f)))
    assert by_row(o8.fingerprints(edge_docs(spark), partitions)) == sorted(want, key=repr)


def test_fingerprints_of_one_and_no_document(spark):
    one = o8.fingerprints(spark.createDataFrame([(1, "abcdefgh")], "doc_id long, text string")).collect()
    assert len(one) == 1 and one[0].edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest() and one[0].near_next == 1.0
    assert o8.fingerprints(empty_docs(spark)).count() == 0


def test_chunks_keep_every_row():
    from raw2clean.llm.common import chunks
    batch = pa.RecordBatch.from_arrays([pa.array(["x" * n for n in (0, 5, 100, 0, 3, 50)])], ["text"])
    parts = list(chunks(iter([batch, batch.slice(2, 3)]), 10))
    assert pa.Table.from_batches(parts).column("text").to_pylist() == batch.column("text").to_pylist() + batch.slice(2, 3).column("text").to_pylist()


def test_generations_of_the_cache(monkeypatch):
    """Ids don't depend on what a worker keeps, and it keeps no more than two generations."""
    rnd = random.Random(4)
    words = ["".join(rnd.choices("abcdefg é", k=rnd.randint(1, 9))) for _ in range(300)]
    text = " ".join(rnd.choice(words) for _ in range(20_000))
    path = public_tokenizers.path(o3.RANKS)
    plain = o3.Worker(path, public_tokenizers.PATTERN).encode(text)
    monkeypatch.setattr(o3, "CACHE_BYTES", 3000)
    worker = o3.Worker(path, public_tokenizers.PATTERN)
    assert worker.encode(text) == plain
    assert max(len(worker.young), len(worker.old)) <= 3000 // o3.ENTRY + 1
    assert worker.pairs.decode(np.frombuffer(plain, "<u4").tolist()).decode() == text


def plain_fingerprint(text):
    """Signatures from their definition, a byte at a time and without numpy."""
    mask32, mask64, data = (1 << 32) - 1, (1 << 64) - 1, text.encode()

    def mix(h):
        h = (h ^ h >> 30) * 0xBF58476D1CE4E5B9 & mask64
        h = (h ^ h >> 27) * 0x94D049BB133111EB & mask64
        return h ^ h >> 31

    marks = []
    for i in range(len(data)):
        h = 0
        for k in range(min(7, i + 1)):
            h ^= ((data[i - k] + 1) * 0x9E3779B1 & mask32) >> 3 * k
        marks.append(mix(h * 3 & mask32 if i >= 6 else h))
    borders = lambda size: [i + 1 for i, m in enumerate(marks) if m % size == size - 1]

    def signature(size):
        cuts, out, start = borders(size), "", 0
        for end in cuts + [len(data)] * (not cuts or cuts[-1] < len(data)):
            total = sum((b + 1) * pow(0x9E3779B97F4A7C15, k, 1 << 64) for k, b in enumerate(data[start:end]))
            out += "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"[mix((total + (end - start) * 0x9E3779B97F4A7C15) & mask64) >> 58]
            start = end
        return out

    size = 4
    while len(borders(2 * size)) >= 32:
        size *= 2
    return f"{size}:{signature(size)}:{signature(2 * size)}" if data else "4::"


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, before = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[j - 1] + 1, before[j - 1] + (x != y)))
    return row[-1]


def test_fingerprints_from_their_definition():
    rnd = random.Random(8)
    texts = ["", "a", "abcdef", "abcdefg", "x" * 500, "naïve 日本語 ✓ " * 40, *("".join(rnd.choices("abc de\n", k=n)) for n in (7, 40, 333, 2000, 6000))]
    prints = [plain_fingerprint(t) for t in texts]
    assert [o8.fingerprint(t) for t in texts] == prints
    for a in prints:
        for b in prints:
            (m, a1, a2), (n, b1, b2) = a.split(":"), b.split(":")
            pairs = [(a1, b1), (a2, b2)] if m == n else [(a2, b1)] if 2 * int(m) == int(n) else [(a1, b2)] if int(m) == 2 * int(n) else []
            want = 1.0 if a == b else max((1.0 if x == y else 1 - plain_distance(x, y) / max(len(x), len(y)) for x, y in pairs), default=0.0)
            assert o8.likeness(a, b) == pytest.approx(want)


def test_many_rows_of_one_id(spark):
    rnd = random.Random(9)
    rows = [(None if k % 3 else 7, "".join(rnd.choices("ab c", k=rnd.randint(0, 400)))) for k in range(300)] + [(None, "the same")] * 40
    df = spark.createDataFrame(rows, "doc_id long, text string")
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
    want = [(i, len(t), hashlib.sha256(o8.edited(t, n).encode()).hexdigest(), plain_fingerprint(t)) for (i, t), (_, n) in zip(order, order[1:] + order[:1], strict=True)]
    out = o8.fingerprints(df, 8).select("doc_id", "n_chars", "edited_sha256", "fingerprint").collect()
    assert sorted(map(tuple, out), key=repr) == sorted(want, key=repr)
