"""The pipeline's stages, each against the rows it was given, and the registered queries."""

import os

import pytest
from compare import digest, duck
from edge import documents, edge_docs, empty_docs
from test_sets_and_lines import brute_components, kept_lines, near_copies

import __spark_entry__ as E
import corpus_pipeline as P
from raw2clean.llm import registry

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


def test_all_are_registered():
    assert {f"op{n}_" for n in range(1, 14)} == {q.split("_")[0] + "_" for q in registry.Q}
    assert set(registry.Q) | {"pipeline"} <= set(E.queries()) and set(registry.ORACLE_SQL) <= set(E.oracle_sql())
    assert len(P.STAGES) == 5


@pytest.mark.parametrize("name", sorted(registry.Q))
def test_query(spark, name):
    df = registry.Q[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    if name not in registry.ORACLE_SQL:
        assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
        return
    res = duck(SF).sql(registry.ORACLE_SQL[name])
    assert sorted(df.columns) == sorted(res.columns)
    assert digest(df.columns, rows)[1] == digest(res.columns, res.fetchall())[1]


def test_run(spark):
    out = P.run(spark, SF)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and out.count() > 100


def test_stages_keep_columns_and_odd_rows(spark):
    for docs in (edge_docs(spark), empty_docs(spark)):
        for _, stage in P.STAGES[:-1]:
            out = stage(spark, docs, SF)
            assert out.columns == docs.columns and (out.count() > 0) == (docs.count() > 0)
        assert P.STAGES[-1][1](spark, docs, SF).count() == docs.count()


def test_line_stage(spark):
    docs = edge_docs(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = sorted((repr((r.doc_id, r.text or "", r.n_chars)) for r in P.line_dedup(spark, docs, SF).collect()))
    assert got == sorted(repr((i, kept, len(kept))) for i, _, _, kept in kept_lines(rows))


def test_near_duplicate_stage(spark):
    texts = [*near_copies(3, 90), "", None]
    docs = documents(spark, texts)
    got = sorted(r.doc_id for r in P.near_duplicates(spark, docs.unionByName(docs.where("doc_id < 9")), SF).collect())
    assert got == [i for i, _, c in sorted(brute_components(list(enumerate(texts)))) if i == c]


def test_near_duplicate_stage_goes_by_text(spark):
    """Null and repeated ids: one row of each component, by content, and all rows without words."""
    base = " ".join(f"w{k}" for k in range(40))
    other = " ".join(f"v{k}" for k in range(40))
    third = " ".join(f"u{k}" for k in range(40))
    rows = [(None, base), (None, base + " end"), (None, "a text of no id"), (None, "another one"), (None, "another one"), (None, ""), (None, None), (None, ""),
            (8, "x"), (8, "x"), (8, "another text for the same id"),
            (3, other), (5, other + " end"), (5, "a distinct text of five"), (3, other + " and"), (None, other + " or"),   # near copies under 3, 5 and none
            (7, third), (6, "six"), (7, third + " end"), (7, "")]
    docs = spark.createDataFrame([(i, t, "en", str(k), 0) for k, (i, t) in enumerate(rows)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted(((r.doc_id, r.text) for r in P.near_duplicates(spark, docs, SF).collect()), key=repr)
    want = [(None, base), (None, "a text of no id"), (None, "another one"), (None, ""), (None, None), (None, ""), (8, "x"), (8, "another text for the same id"),
            (3, other), (5, "a distinct text of five"), (7, third), (6, "six"), (7, "")]
    assert got == sorted(want, key=repr)


def test_quality_stage_is_the_classifier(spark):
    """The rows that the operator accepts, whatever other columns they have; the last statistics' bits depend on nothing else."""
    from raw2clean.llm import op05_quality
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    judged = {r.doc_id for r in op05_quality.classify(docs, spark.read.parquet(f"{SF}/labels.parquet")).collect() if r.predicted}
    got = P.quality(spark, docs, SF)
    assert got.columns == docs.columns and {r.doc_id for r in got.collect()} == judged and 0 < len(judged) < docs.count()
