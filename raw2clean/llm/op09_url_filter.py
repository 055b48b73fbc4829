"""URL filters: rules indexed by their rarest literal token. DataFrame functions only.

Rules are a table (kind, verdict, rule), of a few rows or many. Every rule becomes a regular
expression over host and path, and a set of
literal tokens (runs of ASCII letters and digits) that each url it fits
must hold whole. One aggregate counts how many urls hold each rule
token; a rule is indexed by its rarest. The tokens of a url fetch candidate
rules from that index, those whose other tokens the url lacks go, and only the others run their
expression. Of the rules that fit, the one of the highest precedence decides; it is a maximum by row,
combined before the only shuffle.

The index is a stored table, so Spark knows its size: it is sent to the urls below the session's
broadcast threshold; above it, urls' tokens and index meet by a sort-merge join, where
AQE splits tokens that many urls hold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from raw2clean.llm.common import read, stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: The rules of the contract, (verdict, host and path).
RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
         ("allow", "com/fr/"), ("block", "com/de/")]

#: The method's own rules, for urls that no rule above fits: a word of the host or path, as a whole token.
WORDS = [("block", w) for w in ("spam", "casino", "porn", "xxx", "malware", "phishing")]
DEFAULT = "allow"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _tokens(subject: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.translate(subject, UPPER, LOWER), F.lit("([a-z0-9]+)"), F.lit(1)))


def _escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"([\\^$.|?*+()\[\]{}\-&~#])", r"\\$1")


def compiled(rules: DataFrame) -> DataFrame:
    """regex, tokens and precedence of the rules (kind, verdict, rule).

    Kind ``host``: ``host/path`` fits the host and its subdomains, and paths that start with the path.
    Kind ``word``: a word of host or path, ASCII case aside, for urls that no host rule fits. The longer rule wins, then
    block, then the text. Rows with a null, or of another kind, are no rules; repeated ones count once.
    """
    rules = rules.select(*[F.col(c).cast("string").alias(c) for c in ("kind", "verdict", "rule")]).dropna()
    rules = rules.where(F.col("kind").isin("host", "word")).distinct()
    of_host = F.col("kind") == "host"
    host = F.translate(F.substring_index("rule", "/", 1), UPPER, LOWER)
    path = F.substr("rule", F.char_length(host) + 1)
    literal = F.when(of_host, F.concat(host, F.regexp_replace(path, r"[A-Za-z0-9]+\z", ""))).otherwise(F.col("rule"))
    border = F.when(path == "", F.lit(r"(?=/|\z)")).otherwise(F.lit(""))   # without a path the host ends here
    regex = (F.when(of_host, F.concat(F.lit(r"^(?:[^/]*\.)?"), _escaped(host), _escaped(path), border))
             .otherwise(F.concat(F.lit("(?i)(?<![a-z0-9])"), _escaped(F.col("rule")), F.lit("(?![a-z0-9])"))))
    best = F.struct(of_host.cast("int").alias("level"), F.char_length("rule").alias("length"), (F.col("verdict") == "block").alias("block"),
                    F.col("rule").alias("text"), F.when(of_host, F.col("rule")).alias("rule"), "verdict")
    return rules.select(regex.alias("regex"), _tokens(literal).alias("need"), best.alias("best"))


def _index(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """token, regex, need, best: each rule under the token of its own that the fewest urls hold; under the empty one where it has none."""
    wanted = rules.select(F.explode("need").alias("token")).distinct()
    seen = (urls.select(F.explode(_tokens(F.concat("host", "path"))).alias("token")).join(wanted, "token")
            .groupBy("token").agg(F.count("*").alias("n")))
    rarest = (rules.withColumn("token", F.explode("need")).join(seen, "token", "left")
              .groupBy("regex", "need", "best").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token")).alias("rarest"))
              .select(F.col("rarest.token").alias("token"), "regex", "need", "best"))
    return stored(rarest.unionByName(rules.where(F.size("need") == 0).withColumn("token", F.lit(""))), "url-rules")


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = DEFAULT) -> DataFrame:
    """page_id, host, path, rule, verdict for every row of ``pages``; rules as in ``compiled``.

    A null url, or one without ``://``, has an empty host and path and gets
    the default verdict. Repeated rows and null ids give a row each. Other
    columns are not read. Without rules every verdict is the default.
    """
    urls = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url")).select(
        F.monotonically_increasing_id().alias("row"), "page_id", host_of(F.col("url")).alias("host"),
        path_of(F.col("url")).alias("path"))
    index = _index(urls, compiled(rules))
    # every url holds the empty token: there it meets the row that stands for the default
    none = pages.sparkSession.range(1).select(F.lit("").alias("token"), *[F.lit(None).cast(index.schema[c].dataType).alias(c) for c in ("regex", "need", "best")])
    # regexp_instr keeps the expression it compiled last; rlike would compile a column's anew for each row
    fits = "regex IS NULL OR (size(array_except(need, tokens)) = 0 AND regexp_instr(concat(host, path), regex) > 0)"
    best = (urls.withColumn("tokens", _tokens(F.concat("host", "path")))
            .withColumn("token", F.explode(F.array_append("tokens", F.lit("")))).join(index.unionByName(none), "token")
            .where(fits).groupBy("row", "page_id", "host", "path").agg(F.max("best").alias("best")))
    return best.select("page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))


def production_rules(spark: SparkSession) -> DataFrame:
    return spark.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(kind).alias("kind"), F.lit(v).alias("verdict"), F.lit(t).alias("rule"))
        for kind, rules in (("host", RULES), ("word", WORDS)) for v, t in rules])))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(read(spark, sf_dir, "pages"), production_rules(spark))


OP9_SQL = """
WITH u AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
r(v, h, p) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
                      ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
n AS (SELECT row_number() OVER () AS k, * FROM u),
f AS (SELECT k, arg_max(h || p, length(h || p)) AS rule, arg_max(v, length(h || p)) AS v
      FROM n JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY k)
SELECT page_id, host, path, rule,
       coalesce(v, CASE WHEN regexp_matches(lower(host || path),
         '(^|[^a-z0-9])(spam|casino|porn|xxx|malware|phishing)($|[^a-z0-9])') THEN 'block' ELSE 'allow' END) AS verdict
FROM n LEFT JOIN f USING (k)
"""
