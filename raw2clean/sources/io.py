"""Reading and writing tables.

Reads are plain ``spark.read`` scans: every file of a folder is split across
tasks, and only columns a later ``select`` needs are parsed. Text columns
stay text (``types="string"``, the default): a schema-inference pass costs a
full extra read of the input and turns ``001`` into ``1``.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from raw2clean.functions.rules import as_column
from raw2clean.sources.first_lines import first_lines

# How a year is found in a file path, and the text used when none is.
YEAR_PATTERN = r"_(\d{4})"
YEAR_UNKNOWN = "Unknown"

#: Spark's header reads (one for each different header line) that run at a time.
HEADER_JOBS = 16


def string_schema(columns: Iterable[str]) -> StructType:
    """A schema of nullable string columns (S4's declared all-string schema)."""
    return StructType([StructField(c, StringType(), True) for c in columns])


def _csv_reader(spark: SparkSession, types: str = "string", schema: StructType | None = None,
                header: bool = True, sep: str = ",", quote: str = '"', escape: str | None = None,
                recursive: bool = False, pattern: str | None = None, multiline: bool = False,
                check_headers: bool = False):
    r = spark.read.option("header", header).option("sep", sep).option("quote", quote)
    if check_headers:   # Spark then compares every file's header with the schema and fails on another
        r = r.option("enforceSchema", False)
    if escape is not None:
        r = r.option("escape", escape)
    if schema is not None:
        r = r.schema(schema)
    elif types == "infer":
        r = r.option("inferSchema", True)
    elif types != "string":
        raise ValueError(f"types must be 'string' or 'infer', not {types!r}")
    if recursive:
        r = r.option("recursiveFileLookup", True)
    if pattern:
        r = r.option("pathGlobFilter", pattern)
    if multiline:
        r = r.option("multiLine", True)
    return r


def read_table(spark: SparkSession, path: str | list[str], types: str = "string",
               schema: StructType | None = None, header: bool = True, sep: str = ",",
               quote: str = '"', escape: str | None = None, recursive: bool = False,
               pattern: str | None = None, multiline: bool = False,
               promote_first_row: bool = False, year_column: str | None = None,
               year_pattern: str = YEAR_PATTERN, year_source: str = "below",
               check_headers: bool = False) -> DataFrame:
    """A CSV table with a header line.

    ``types="string"`` reads every column as text; ``"infer"`` runs Spark's
    inference pass (legacy behaviour); ``schema`` declares the columns.
    ``promote_first_row``: the real header is the first data row (S10, the
    2000 layout): it is found in file order and used as column names.
    ``check_headers``: fail where a file's header differs from the columns,
    instead of reading it by position.
    ``year_column``: add the year of each row's file (S11), looked for in its
    name, then in the folders between it and what was read (``year_source=
    "below"``), in its name alone (``"name"``) or in the whole path (``"path"``).
    """
    reader = _csv_reader(spark, types, schema, header, sep, quote, escape, recursive, pattern, multiline, check_headers)
    df = reader.csv(path)
    if promote_first_row:
        df = promote_header(df, header=first_row(reader, spark, path, pattern, recursive, header))
    if year_column:
        df = df.withColumn(year_column, year_of_file(path, year_pattern, year_source))
    return df


def year_of_file(path: str | list[str], pattern: str = YEAR_PATTERN, source: str = "below") -> Column:
    """The year in the name of a row's file, else in its folders below the read ``path``, else ``Unknown``."""
    name = F.regexp_extract(F.col("_metadata.file_name"), pattern, 1)
    if source == "name":
        found = name
    elif source == "path":
        found = F.regexp_extract(F.col("_metadata.file_path"), pattern, 1)
    elif source == "below":
        roots = sorted({_plain(p) for p in ([path] if isinstance(path, str) else path)}, key=len, reverse=True)
        file = F.regexp_replace(F.try_url_decode(F.replace("_metadata.file_path", F.lit("+"), F.lit("%2B"))), "^[A-Za-z][A-Za-z0-9+.-]*:/*", "/")
        below = F.lit("")
        for root in roots[::-1]:   # the longest root that holds the file is asked last, and so decides
            below = F.when(file.startswith(root.rstrip("/") + "/"), F.substring(file, len(root.rstrip("/")) + 1, 1 << 30)).otherwise(below)
        folders = F.regexp_extract(F.regexp_replace(below, "[^/]*$", ""), pattern, 1)
        found = F.when(name != "", name).otherwise(folders)
    else:
        raise ValueError(f"unknown year source {source!r}")
    return F.when(found == "", F.lit(YEAR_UNKNOWN)).otherwise(found)


def _plain(path: str) -> str:
    """A path without its scheme, and without what a glob pattern leaves open."""
    path = re.sub("^[A-Za-z][A-Za-z0-9+.-]*:/*", "/", path)
    if not path.startswith("/"):
        path = os.path.join(os.getcwd(), path)
    fixed = re.split(r"(?<!\\)[*?\[{]", path)[0]
    if fixed != path:
        fixed = fixed.rpartition("/")[0]
    return re.sub(r"\\(.)", r"\1", fixed)


def escape_glob(path: str) -> str:
    """A path that Spark's readers take as it is, not as a pattern."""
    return re.sub(r"([*?\[\]{}\\])", r"\\\1", path)


def first_row(reader, spark: SparkSession, path: str | list[str], pattern: str | None = None, recursive: bool = False,
              header: bool = True) -> list:
    """The first data row in file order: of the first file by path that has one.

    One job asks all files whether they have a row, and takes the first of those that have; Spark's reader
    then reads that file's row. Only where files can't be asked, or where a
    quoted cell of a header line runs over several lines, files are read one after another from there on.
    """
    files = list_files(spark, path, pattern or "*", recursive, empty=False)
    if not files:
        return []
    has_row = F.col("more") if header else F.col("line").isNotNull()
    start = first_lines(spark, files).where(~F.col("opened") | has_row).agg(F.min("file")).first()[0]
    for file in files[files.index(start):] if start is not None else []:
        if row := reader.csv(escape_glob(file)).head(1):
            return list(row[0])
    return []


def promote_header(df: DataFrame, header: list | None = None) -> DataFrame:
    """The first row becomes the column names.

    Rows whose first column equals the header's first value are dropped (the
    header row and any repeat of it); rows with a NULL first column are kept.
    A NULL header cell becomes the name ``None``. ``header`` defaults to
    ``df.first()``; ``read_table(promote_first_row=True)`` passes the first
    row in file order instead.
    """
    if header is None:
        first = df.first()
        if first is None:
            return df
        header = list(first)
    if not header:
        return df
    names = [str(v) for v in header]
    first_col = as_column(df.columns[0])
    kept = df.where(~first_col.eqNullSafe(F.lit(header[0])))
    return kept.toDF(*names)


def list_files(spark: SparkSession, path: str | list[str], pattern: str = "*.csv",
               recursive: bool = True, empty: bool = True) -> list[str]:
    """S3: every file below ``path`` whose name matches ``pattern``, sorted; without ``empty``, files of no bytes are left out.

    Spark lists the folder (in parallel for large folders); the file contents
    are not read, since only path and length are selected. The driver holds
    the paths, as it does for any file scan.
    """
    return [r["path"] for r in _listed(spark, path, pattern, recursive, empty)]


def files_by_year(spark: SparkSession, path: str, pattern: str = "*.csv", recursive: bool = True,
                  year_pattern: str = YEAR_PATTERN, source: str = "below") -> dict[str, str]:
    """S3 + S11: every file as ``list_files`` finds it, and its year as ``year_of_file`` has it, from the listing alone."""
    return {r["path"]: r["year"] for r in _listed(spark, path, pattern, recursive, True, year_of_file(path, year_pattern, source).alias("year"))}


def _listed(spark: SparkSession, path: str | list[str], pattern: str, recursive: bool, empty: bool, *more: Column) -> list[Row]:
    r = spark.read.format("binaryFile").option("pathGlobFilter", pattern)
    if recursive:
        r = r.option("recursiveFileLookup", True)
    try:
        rows = r.load(path).where(F.lit(empty) | (F.col("length") > 0)).select("path", *more).collect()
    except Exception as e:  # an empty or absent folder
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return []
        raise
    return sorted(rows, key=lambda r: r["path"])


def group_by_header(spark: SparkSession, files: list[str]) -> list[tuple[list[str], list[str]]]:
    """(columns, files) for each different header, in order of the first file.

    One job reads the first line of every file on the executors and groups the files by it;
    Spark's own header read then tells the columns of each different line, from
    one of its files. Only files that the workers can't open are asked one by one.
    A file without any line has no rows and is left out.
    """
    if not files:
        return []
    found = (first_lines(spark, files).where(~F.col("opened") | F.col("line").isNotNull())
             .groupBy("opened", "line").agg(F.array_sort(F.collect_list("file")).alias("files")).select("opened", "files").collect())
    alike = [r["files"] for r in found if r["opened"]] + [[f] for r in found if not r["opened"] for f in r["files"]]
    read = lambda of: tuple(_csv_reader(spark).csv(escape_glob(of[0])).columns)
    groups: dict[tuple[str, ...], list[str]] = {}
    with ThreadPoolExecutor(HEADER_JOBS) as pool:
        for of, head in zip(alike, pool.map(read, alike), strict=True):
            if head:
                groups.setdefault(head, []).extend(of)
    return sorted(((list(head), sorted(of)) for head, of in groups.items()), key=lambda g: g[1][0])


def read_group(spark: SparkSession, columns: list[str], files: list[str], **kw) -> DataFrame:
    """Files of one header as one scan. Spark itself checks the header of each file where there are several."""
    return read_table(spark, [escape_glob(f) for f in files], schema=string_schema(columns), check_headers=len(files) > 1, **kw)


def write_table(df: DataFrame, path: str, fmt: str = "csv", mode: str = "overwrite",
                partition_by: Iterable[str] | None = None, single_file: bool = False,
                compression: str | None = None, header: bool = True) -> None:
    """Write a table as CSV (with header), JSON or Parquet.

    ``mode="overwrite"`` by default: ``append`` doubles the rows when a job
    runs twice. With ``partition_by`` set, overwrite replaces only the
    partitions written (dynamic partition overwrite). ``single_file=True``
    (S7) writes one file through ``repartition(1)``: the scan and the work
    before it stay parallel, but the whole table passes one writer task, so
    use it only for small outputs.
    """
    if single_file:
        df = df.repartition(1)
    w = df.write.mode(mode)
    parts = list(partition_by or [])
    if parts:
        w = w.partitionBy(*parts)
        if mode == "overwrite":
            w = w.option("partitionOverwriteMode", "dynamic")
    if fmt == "csv":
        w = w.option("header", header)
        if compression:
            w = w.option("compression", compression)
        w.csv(path)
    elif fmt == "json":
        w.option("compression", compression or "none").json(path)
    elif fmt == "parquet":
        w.option("compression", compression or "snappy").parquet(path)
    else:
        raise ValueError(f"unknown format {fmt!r}")


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` rows (opt-in: it starts its own job)."""
    return df.limit(n)


def work_dir(spark: SparkSession, name: str = "raw2clean") -> str:
    """A fresh folder under the cluster's shared checkpoint folder.

    The folder comes from ``spark.checkpoint.dir``. Where that is unset, a
    local session (one machine, as in tests) gets a temporary folder; on a cluster it is an
    error, since executors would each write to their own disk.
    """
    sc = spark.sparkContext
    base = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not base:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="raw2clean-ckpt-")
        sc.setCheckpointDir(base)
        base = sc.getCheckpointDir() or base
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")
