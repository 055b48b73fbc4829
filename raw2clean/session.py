"""A local SparkSession for tests and benchmarks (a cluster brings its own)."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


#: For jobs over dozens of rule columns. Whole-stage code of so many rules is one method too long for
#: the JVM to compile (8,000 bytes of bytecode), or even for a class file, and runs interpreted; Spark's
#: plain projection splits the rules into methods that are compiled. Measured in the README.
WIDE_RULES = {"spark.sql.codegen.hugeMethodLimit": "8000", "spark.sql.codegen.maxFields": "30"}
#: Spark's own values of these settings: what a session has where nobody chose one.
_DEFAULTS = {"spark.sql.codegen.hugeMethodLimit": "65535", "spark.sql.codegen.maxFields": "100"}


def for_wide_rules(spark: SparkSession) -> None:
    """Give a session ``WIDE_RULES``, but for settings it has a value of its own for. Results don't depend on them."""
    for key, value in WIDE_RULES.items():
        if spark.conf.get(key, _DEFAULTS[key]) == _DEFAULTS[key]:
            spark.conf.set(key, value)


#: Spark (4.1) then drops what a query shuffled when the query ends. Otherwise it stays on the executors' disks until
#: the driver's JVM collects the query's plan, which a driver with memory to spare does late.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Within it, queries of the session give their shuffle files back at their end. For writes one after another;
    a ``DataFrame`` that is collected twice there shuffles twice, with the same result."""
    before = spark.conf.get(FREE_SHUFFLES, "false")
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(FREE_SHUFFLES, before)


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, ansi: bool | None = None,
                  app: str = "raw2clean") -> SparkSession:
    scratch = os.environ.get("RAW2CLEAN_SCRATCH") or tempfile.mkdtemp(prefix="raw2clean-")
    b = (SparkSession.builder.master(f"local[{cpus}]").appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.driver.memory", os.environ.get("RAW2CLEAN_DRIVER_MEMORY", "8g"))
         .config("spark.local.dir", os.path.join(scratch, "local"))
         .config("spark.sql.warehouse.dir", os.path.join(scratch, "warehouse"))
         .config("spark.checkpoint.dir", os.path.join(scratch, "checkpoint")))
    for key, value in WIDE_RULES.items():
        b = b.config(key, value)
    if ansi is not None:
        b = b.config("spark.sql.ansi.enabled", str(ansi).lower())
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
