"""A corpus pipeline in five stages, each an operator of ``raw2clean.llm``.

``documents`` is scored for quality, rejects go; repeated lines are dropped;
one document of each group of near duplicates stays; sources are mixed to
their target weights; the texts are encoded as byte-level BPE ids. Each stage's
rows are written as Parquet and read again by the next.

All but the last stage return the columns of ``documents``, extra ones too. Empty
tables, null texts and repeated rows pass as the operators define; n_chars is
the length of the text that a stage returns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from raw2clean.llm import op03_byte_bpe, op05_quality, op06_mixing, op07_line_dedup, op10_ngram_jaccard
from raw2clean.llm.common import as_struct, importable, read, stored, text_key

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the quality classifier (5) accepts, each judged by itself."""
    _, model = op05_quality.train(docs, read(spark, sf_dir, "labels"))
    return op05_quality.accepted(docs, model)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, without the lines that line dedup (7) drops."""
    out = op07_line_dedup.dedup_lines(docs)
    value = {"text": F.when(F.col("row.text").isNull(), F.lit(None)).otherwise(F.col("kept")),
             "n_chars": F.char_length(F.coalesce("kept", F.lit(""))).cast("long")}
    return out.select(*[value.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of the n-gram Jaccard join (10): that of the smallest id, a null one last, and of its smallest text.

    Rows without words are no one's duplicates and stay. Rows alike in id and
    text are one row. Rows that share an id and nothing else are documents of their own.
    """
    row_id, row_text = docs["doc_id"].cast("long"), docs["text"].cast("string")
    of_row = [row_id.alias("_id"), text_key(row_text).alias("_key")]
    same = lambda other: row_id.eqNullSafe(other["_id"]) & (text_key(row_text) == other["_key"])
    # a row for each text of an id: all rows of a text are in one component
    leads = F.col("component_id").eqNullSafe(F.col("doc_id"))
    each = stored(op10_ngram_jaccard.link_rows(docs).groupBy(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"))
                  .agg(F.min("component").alias("component"), F.bool_or(leads).alias("stays"), F.count("*").alias("n")), "linked")
    first = each.where("stays and component is not null")
    several = first.groupBy("component").agg(F.count("*").alias("m")).where("m > 1").select("component")
    if not several.isEmpty():   # texts that share the smallest id of their component: only these are compared
        tied = stored(first.join(several, "component", "left_semi").select("_id", "_key", "component"), "tied")
        least = (docs.select(row_text.alias("text"), *of_row).join(tied.select(F.col("_id").alias("id"), F.col("_key").alias("key"), "component"),
                                                                   F.col("_id").eqNullSafe(F.col("id")) & (F.col("_key") == F.col("key")))
                 .groupBy("component").agg(F.min("text").alias("text")).select("component", text_key("text").alias("least")))
        each = stored(each.join(least, "component", "left")
                      .withColumn("stays", F.col("stays") & F.coalesce(F.col("least") == F.col("_key"), F.lit(True))).drop("least"), "linked")
    # what goes is less than what stays: ids of which no row stays, rarely too many for Spark to send them to the texts;
    # of the other ids single texts
    ids = each.groupBy("_id").agg(F.bool_or("stays").alias("some"), F.bool_and("stays").alias("all"))
    gone = stored(ids.where("not some").select("_id"), "gone")
    kept = docs.join(gone, row_id.eqNullSafe(gone["_id"]), "left_anti")
    mixed = ids.where("some and not all").select(F.col("_id").alias("_mixed"))
    lost = stored(each.where("not stays").join(mixed, F.col("_id").eqNullSafe(F.col("_mixed")), "left_semi").select("_id", "_key"), "lost")
    if not lost.isEmpty():
        kept = kept.join(lost, same(lost), "left_anti")
    again = each.where("stays and component is not null and n > 1").select("_id", "_key")
    if again.isEmpty():
        return kept
    one = (kept.join(again, same(again), "left_semi").select(*of_row, as_struct(docs).alias("_row"))
           .groupBy("_id", "_key").agg(F.min("_row").alias("_row")))
    return kept.join(again, same(again), "left_anti").unionByName(one.select("_row.*"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix (6): rows as often as it takes them."""
    return op06_mixing.mixed(docs, op06_mixing.plan_mix(docs))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row's text encoded and decoded again (3): doc_id, n_tokens, ids_sha256, decoded_sha256."""
    import public_tokenizers
    return op03_byte_bpe.round_trip(docs, public_tokenizers.path(op03_byte_bpe.RANKS), public_tokenizers.PATTERN)


STAGES: list[tuple[str, Stage]] = [("quality", quality), ("line_dedup", line_dedup), ("near_duplicates", near_duplicates),
                                   ("mixing", mixing), ("byte_bpe", byte_bpe)]

#: No stage list as a whole can be said in SQL: the classifier is trained, and the mix draws from hashes. Tested by brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; what the last one returns."""
    docs = read(importable(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
