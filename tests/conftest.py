import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from raw2clean.session import local_session
    s = local_session("*", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture(params=[True, False], ids=["ansi", "legacy"])
def ansi_spark(spark, request):
    """The session with ANSI mode on, then off: rules must agree."""
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", str(request.param).lower())
    yield spark
    spark.conf.set("spark.sql.ansi.enabled", old)


@pytest.fixture
def tmp_dir():
    return tempfile.mkdtemp(prefix="raw2clean-test-", dir="/tmp")
