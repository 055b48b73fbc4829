"""The rules over a CSV file stream; a restarted query resumes from its checkpoint."""

import os

from raw2clean.functions import rules as R
from raw2clean.plans.ruleset import RuleSet
from raw2clean.streaming.stream import clean_stream, run_available


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_stream_resumes_from_checkpoint(spark, tmp_dir):
    rules = RuleSet({"k": R.passthrough(), "code": R.keep_codes(["1", "2"])})
    _write(f"{tmp_dir}/in/a.csv", "k,code\n1,1\n2,9\n,\n")
    _write(f"{tmp_dir}/in/b.csv", "k,code\n3,2\n")
    out, ckpt = f"{tmp_dir}/out", f"{tmp_dir}/ckpt"
    run_available(clean_stream(spark, f"{tmp_dir}/in", rules, columns=["k", "code"]), out, ckpt)
    first = sorted(tuple(r) for r in spark.read.parquet(out).collect())
    assert first == [("1", "1"), ("2", None), ("3", "2")]      # the all-empty row is dropped
    # a new file arrives; the restarted query reads only it
    _write(f"{tmp_dir}/in/c.csv", "k,code\n4,1\n")
    run_available(clean_stream(spark, f"{tmp_dir}/in", rules, columns=["k", "code"]), out, ckpt)
    again = sorted(tuple(r) for r in spark.read.parquet(out).collect())
    assert again == [("1", "1"), ("2", None), ("3", "2"), ("4", "1")]
