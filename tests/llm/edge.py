"""Small tables with every odd case: nulls, empty and very long texts, ties, repeats, extra columns."""

from pyspark.sql import DataFrame, SparkSession

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "key string, row int, size int, `a.b` string, score double")
LONG = "Word after word runs on here\n" * 3000 + "x" * 20000

TEXTS = [
    (1, "one two three four five six\nA line that is long enough to count\nshort", "a"),
    (2, "One TWO three four five six\n  a line that is long enough to count \nshort", "a"),
    (3, "", "b"), (4, None, None), (5, "   \n\t ", "b"), (6, LONG, "c"), (7, "naïve café 日本語 ✓ ﬁ​\x00end", "c"),
    (8, "x", None), (8, "x", None), (8, "another text for the same id", "d"), (None, "no id here", "a"), (None, "no id here", None),
    (9, "one two three four five six\nA line that is long enough to count\nshort", "a"),
    (10, "A line that is long enough to count", ""), (11, "one two", "a"), (12, "ONE two", "a"), (-5, "negative \r\n id  ", "e"),
]


def edge_docs(spark: SparkSession) -> DataFrame:
    rows = [(i, t, None if k % 3 else "en", s, None if t is None else len(t), None if k % 2 else "k", k, None, "dot", None)
            for k, (i, t, s) in enumerate(TEXTS)]
    return spark.createDataFrame(rows, SCHEMA)


def empty_docs(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def documents(spark: SparkSession, texts: list[str | None], source: str = "s") -> DataFrame:
    return spark.createDataFrame([(i, t, "en", source, len(t or "")) for i, t in enumerate(texts)],
                                 "doc_id long, text string, lang string, source string, n_chars long")


def labels(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
