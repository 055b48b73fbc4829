"""Files: CSV/JSON/Parquet write and read back, header promotion, year from
path, listing by pattern, merge of a folder with mixed headers."""

import json
import os
import subprocess
import sys

import pytest

from raw2clean.plans.jobs import merge_folder, run_merge
from raw2clean.sources import io


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_read_strings_keeps_leading_zeros(spark, tmp_dir):
    _write(f"{tmp_dir}/t.csv", "a,b\n001,0201.00\n0000451966,x\n")
    df = io.read_table(spark, f"{tmp_dir}/t.csv")
    assert df.dtypes == [("a", "string"), ("b", "string")]
    assert [tuple(r) for r in df.collect()] == [("001", "0201.00"), ("0000451966", "x")]
    inferred = io.read_table(spark, f"{tmp_dir}/t.csv", types="infer")
    assert dict(inferred.dtypes)["a"] in ("int", "bigint")


def test_declared_schema(spark, tmp_dir):
    _write(f"{tmp_dir}/t.csv", 'a b,c\n"x, y",1\n')
    df = io.read_table(spark, f"{tmp_dir}/t.csv", schema=io.string_schema(["a b", "c"]))
    assert df.first()["a b"] == "x, y"


def test_promote_header(spark, tmp_dir):
    _write(f"{tmp_dir}/h.csv", "junk1,junk2,junk3\nid,name,None\n1,a,x\nid,b,y\n,c,z\n")
    df = io.read_table(spark, f"{tmp_dir}/h.csv", promote_first_row=True)
    assert df.columns == ["id", "name", "None"]
    # the header row and its repeat are dropped; the NULL first column is kept
    assert sorted((tuple(r) for r in df.collect()), key=str) == sorted([("1", "a", "x"), (None, "c", "z")], key=str)


def test_promote_header_from_first_row(spark):
    df = spark.createDataFrame([("k", None), ("1", "2")], "a string, b string")
    out = io.promote_header(df)
    assert out.columns == ["k", "None"] and out.count() == 1


def test_year_from_path(spark, tmp_dir):
    _write(f"{tmp_dir}/acs_x_2015.csv", "a\n1\n")
    _write(f"{tmp_dir}/plain.csv", "a\n2\n")
    df = io.read_table(spark, [f"{tmp_dir}/acs_x_2015.csv", f"{tmp_dir}/plain.csv"], year_column="Year")
    assert sorted(tuple(r) for r in df.collect()) == [("1", "2015"), ("2", "Unknown")]


def test_list_files_pattern(spark, tmp_dir):
    _write(f"{tmp_dir}/a/x_2015.csv", "a\n1\n")
    _write(f"{tmp_dir}/b/y.csv", "a\n1\n")
    _write(f"{tmp_dir}/b/z.txt", "a\n1\n")
    files = io.list_files(spark, tmp_dir)
    assert [os.path.basename(f) for f in files] == ["x_2015.csv", "y.csv"]
    assert io.list_files(spark, f"{tmp_dir}/nothing") == []


def test_round_trips(spark, tmp_dir):
    df = spark.createDataFrame([("1", "a"), ("2", None)], "k string, v string")
    for fmt in ("csv", "json", "parquet"):
        path = f"{tmp_dir}/{fmt}"
        io.write_table(df, path, fmt=fmt)
        io.write_table(df, path, fmt=fmt)  # overwrite, not append
        back = io.read_table(spark, path) if fmt == "csv" else spark.read.schema(df.schema).format(fmt).load(path)
        assert sorted(tuple(r) for r in back.collect()) == [("1", "a"), ("2", None)], fmt


def test_single_file_and_partitions(spark, tmp_dir):
    df = spark.createDataFrame([("1", "2015"), ("2", "2016")], "k string, year string")
    io.write_table(df, f"{tmp_dir}/one", single_file=True)
    assert len([f for f in os.listdir(f"{tmp_dir}/one") if f.endswith(".csv")]) == 1
    io.write_table(df, f"{tmp_dir}/parts", fmt="parquet", partition_by=["year"])
    io.write_table(df.where("year = '2016'"), f"{tmp_dir}/parts", fmt="parquet", partition_by=["year"])
    back = spark.read.parquet(f"{tmp_dir}/parts")
    assert sorted((r["k"], str(r["year"])) for r in back.collect()) == [("1", "2015"), ("2", "2016")]


def _survey(tmp_dir):
    _write(f"{tmp_dir}/acs_x_2015.csv", "geo_id,name,m1e,m1m,m2e,state\n1,A,-888888888,5,(X),01\n2,B,7,(X),,02\n")
    _write(f"{tmp_dir}/acs_x_2016.csv", "geo_id,name,m1e,m1m,m2e,state\n3,C,8,1,4,03\n")
    _write(f"{tmp_dir}/sub/acs_y_2017.csv", "state,m1e,geo_id,name\n04,9,5,E\n")
    _write(f"{tmp_dir}/acs_x_2018.csv", "geo_id,name,m1e,m1m,m2e,state\n")
    _write(f"{tmp_dir}/no_year.csv", "geo_id,name,m1e,m1m,m2e,state\n6,F,,,,06\n")
    _write(f"{tmp_dir}/notes.txt", "geo_id\nignored\n")


def test_merge_folder(spark, tmp_dir):
    _survey(tmp_dir)
    out = merge_folder(spark, tmp_dir)
    rows = {r["geo_id"]: r.asDict() for r in out.collect()}
    assert out.columns == ["geo_id", "name", "m1e", "m1m", "m2e", "state", "Year"]
    assert set(rows) == {"1", "2", "3", "5", "6"}
    assert rows["1"]["m1e"] is None and rows["1"]["m2e"] is None and rows["1"]["Year"] == "2015"
    assert rows["5"] == {"geo_id": "5", "name": "E", "m1e": "9", "m1m": None, "m2e": None,
                         "state": "04", "Year": "2017"}
    assert rows["6"]["Year"] == "Unknown"


def test_merge_drops_columns_empty_everywhere(spark, tmp_dir):
    _write(f"{tmp_dir}/a_2015.csv", "k,e\n1,(X)\n")
    _write(f"{tmp_dir}/b_2016.csv", "k,e\n2,\n")
    out = merge_folder(spark, tmp_dir)
    assert out.columns == ["k", "Year"]


def test_run_merge_writes_nothing_without_files(spark, tmp_dir):
    assert run_merge(spark, f"{tmp_dir}/none", f"{tmp_dir}/out") is None
    assert not os.path.exists(f"{tmp_dir}/out")


def test_work_dir_under_checkpoint_dir(spark):
    d = io.work_dir(spark, "x")
    base = spark.sparkContext.getCheckpointDir()
    assert base and d.startswith(base.rstrip("/"))


def test_work_dir_needs_a_shared_folder_on_a_cluster():
    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)
        getConf = staticmethod(lambda: {})

    class Session:
        sparkContext = Context()
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        io.work_dir(Session())


def test_year_below_the_folder_read(spark, tmp_dir):
    base = f"{tmp_dir}/p_2024 x%20#+/in"
    _write(f"{base}/a_2015.csv", "a\n1\n")
    _write(f"{base}/y_2016/a.csv", "a\n2\n")
    _write(f"{base}/y_2016/b_2017.csv", "a\n3\n")
    _write(f"{base}/plain.csv", "a\n4\n")
    read = lambda p, **kw: sorted(tuple(r) for r in io.read_table(spark, p, year_column="Year", **kw).collect())
    assert read(base, recursive=True) == [("1", "2015"), ("2", "2016"), ("3", "2017"), ("4", "Unknown")]
    assert read(base, recursive=True, year_source="name") == [("1", "2015"), ("2", "Unknown"), ("3", "2017"), ("4", "Unknown")]
    assert read(base, recursive=True, year_source="path")[3] == ("4", "2024")
    assert read(f"{base}/plain.csv") == [("4", "Unknown")]
    assert read(f"{base}/*.csv") == [("1", "2015"), ("4", "Unknown")]


@pytest.mark.parametrize("folder", ["plain", "with blank", "100%20", "a#b", "q[1]{x}", "p+q"])
def test_merge_folder_on_any_path(spark, tmp_dir, folder):
    """Given as a path or, with pattern signs escaped, as a pattern. Columns in different orders, a blank line before a header, an empty file, a header alone."""
    base = f"{tmp_dir}/{folder}"
    _write(f"{base}/age a_2015.csv", "a,b\n1,2\n")
    _write(f"{base}/age b_2016.csv", "b,a\n20,10\n")
    _write(f"{base}/c#1_2017.csv", "\n\nb,a\n200,100\n")
    _write(f"{base}/d%20_2018.csv", "\na,b\n3,4\n")
    _write(f"{base}/empty_2019.csv", "")
    _write(f"{base}/head_2020.csv", "b,a\n")
    _write(f"{base}/sub dir/e_2021.csv", "c\n7\n")
    got = sorted((r.Year, r.a, r.b, r.c) for r in merge_folder(spark, io.escape_glob(base)).collect())
    assert got == [("2015", "1", "2", None), ("2016", "10", "20", None), ("2017", "100", "200", None), ("2018", "3", "4", None),
                   ("2021", None, None, "7")]


def test_another_header_in_a_group_is_an_error(spark, tmp_dir):
    _write(f"{tmp_dir}/a.csv", "a,b\n1,2\n")
    _write(f"{tmp_dir}/b.csv", "b,a\n20,10\n")
    with pytest.raises(Exception, match="(?i)header"):
        io.read_group(spark, ["a", "b"], [f"{tmp_dir}/a.csv", f"{tmp_dir}/b.csv"]).collect()


def test_header_reads_touch_one_line(tmp_dir):
    """Records read, from the event log: of a file in many splits, the header alone and the first row alone."""
    _write(f"{tmp_dir}/in/h_2015.csv", "junk1,junk2\nid,name\n" + "".join(f"{i},some text here to fill the line\n" for i in range(15_000)))
    os.makedirs(f"{tmp_dir}/log")
    code = f"""
import sys; sys.path.insert(0, {os.path.dirname(os.path.dirname(os.path.abspath(__file__)))!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.files.maxPartitionBytes", "64k")
         .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", "file://{tmp_dir}/log").config("spark.eventLog.compress", "false")
         .config("spark.eventLog.rolling.enabled", "false").getOrCreate())
from raw2clean.sources import io
df = io.read_table(spark, "{tmp_dir}/in", promote_first_row=True)
assert df.columns == ["id", "name"], df.columns
assert io.group_by_header(spark, io.list_files(spark, "{tmp_dir}/in"))[0][0] == ["junk1", "junk2"]
spark.stop()
"""
    subprocess.run([sys.executable, "-c", code], check=True, capture_output=True)
    read, longest = 0, 0
    for name in os.listdir(f"{tmp_dir}/log"):
        for line in open(f"{tmp_dir}/log/{name}"):
            e = json.loads(line)
            if e["Event"] == "SparkListenerTaskEnd":
                n = e["Task Metrics"]["Input Metrics"]["Records Read"]
                read, longest = read + n, max(longest, n)
    assert 0 < longest < 3000 and read < 9000   # a buffer of lines of one split of 64 KB each time, not 40,000


def _jobs(spark, run):
    """What ``run`` returns, and the number of Spark jobs it starts."""
    group = f"jobs-{id(run)}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        out = run()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_headers_of_many_files_in_one_job(spark, tmp_dir):
    for i in range(400):
        _write(f"{tmp_dir}/{i % 7}/f{i:03}.csv", "\n \r\na,b\n1,2\n" if i % 3 == 0 else "b,a\r\n" if i % 3 == 1 else "")
    files = io.list_files(spark, tmp_dir)
    few, jobs_few = _jobs(spark, lambda: io.group_by_header(spark, files[:40]))
    groups, jobs = _jobs(spark, lambda: io.group_by_header(spark, files))
    assert jobs_few <= jobs <= 6     # the grouping, as Spark splits it, and a read for each of two headers
    assert [(c, len(of)) for c, of in sorted(groups)] == [(["a", "b"], 134), (["b", "a"], 133)]
    assert [g[1][0] for g in groups] == sorted(g[1][0] for g in groups) and {f for _, of in few for f in of} <= set(files[:40])
    assert io.group_by_header(spark, []) == []


def test_first_lines_end_as_in_spark(spark, tmp_dir):
    import bz2
    import gzip
    long = ",".join(f"c{i}" for i in range(15_000))
    texts = {"unix": "a,b\n1,2", "dos": "\r\n\r\na,b\r\n1,2\r\n", "mac": "a,b\r1,2\r", "blank": " \n\t\n", "end": "a,b\r", "long": long + "\n1\n",
             "split": "x" * 65535 + "\r\ny\n", "one": "a,b"}
    for name, text in texts.items():
        with open(f"{tmp_dir}/{name}.csv", "w", newline="") as f:
            f.write(text)
    with gzip.open(f"{tmp_dir}/packed.csv.gz", "wt") as f:
        f.write("a,b\n1,2\n")
    with bz2.open(f"{tmp_dir}/packed.csv.bz2", "wt") as f:
        f.write("a,b\n1,2\n")
    files = io.list_files(spark, tmp_dir, "*")
    got = {os.path.basename(r["file"]): (None if r["line"] is None else bytes(r["line"]).decode(), r["more"], r["opened"])
           for r in io.first_lines(spark, files).collect()}
    assert got == {"unix.csv": ("a,b", True, True), "dos.csv": ("a,b", True, True), "mac.csv": ("a,b", True, True), "blank.csv": (None, False, True),
                   "end.csv": ("a,b", False, True), "long.csv": (long, True, True), "one.csv": ("a,b", False, True),
                   "split.csv": ("x" * 65535, True, True), "packed.csv.gz": ("a,b", True, True), "packed.csv.bz2": (None, None, False)}
    groups = io.group_by_header(spark, files)      # what Python can't open is asked of Spark
    assert {tuple(c): len(of) for c, of in groups}[("a", "b")] == 7


def test_files_that_only_spark_reads(spark, tmp_dir):
    _write(f"{tmp_dir}/a.csv", "k,v\n1,2\n")
    _write(f"{tmp_dir}/b.csv", "v,k\n3,4\n")
    _write(f"{tmp_dir}/.hidden.csv", "z\n")
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.first.link./in", f"file://{tmp_dir}")
    files = io.list_files(spark, "viewfs://first/in")
    assert len(files) == 2 and not any(r["opened"] for r in io.first_lines(spark, files).collect())
    assert sorted(c for c, _ in io.group_by_header(spark, files)) == [["k", "v"], ["v", "k"]]
    assert io.first_row(io._csv_reader(spark), spark, "viewfs://first/in") == ["1", "2"]


def test_first_row_after_files_without_rows(spark, tmp_dir):
    for i in range(200):
        _write(f"{tmp_dir}/a{i:03}.csv", "x,y\n" if i % 2 else "")
    _write(f"{tmp_dir}/b.csv", "x,y\n\nk,v\n1,2\n")
    _write(f"{tmp_dir}/c.csv", "x,y\nno,header\n3,4\n")
    reader = io._csv_reader(spark)
    row, jobs = _jobs(spark, lambda: io.first_row(reader, spark, tmp_dir))
    _write(f"{tmp_dir}/other/b.csv", "x,y\nk,v\n")
    assert row == ["k", "v"] and jobs <= _jobs(spark, lambda: io.first_row(reader, spark, f"{tmp_dir}/other"))[1] + 1
    df = io.read_table(spark, tmp_dir, pattern="?*.csv", promote_first_row=True, schema=io.string_schema(["x", "y"]))
    assert df.columns == ["k", "v"] and sorted(tuple(r) for r in df.collect()) == [("1", "2"), ("3", "4"), ("no", "header")]
    assert io.first_row(io._csv_reader(spark, header=False), spark, f"{tmp_dir}/b.csv", header=False) == ["x", "y"]
    _write(f"{tmp_dir}/wide/a.csv", '"x\n1",y\n')          # a header over two lines, and no row
    _write(f"{tmp_dir}/wide/b.csv", "x,y\nk,v\n")
    assert io.first_row(io._csv_reader(spark, multiline=True), spark, f"{tmp_dir}/wide") == ["k", "v"]


def test_merge_with_and_without_a_scan_a_year(spark, tmp_dir, monkeypatch):
    from raw2clean.plans import jobs
    _survey(tmp_dir)
    each = sorted(map(str, merge_folder(spark, tmp_dir).collect()))
    monkeypatch.setattr(jobs, "YEAR_SCANS", 1)
    assert sorted(map(str, merge_folder(spark, tmp_dir).collect())) == each


def test_empty_columns_of_each_file(spark, tmp_dir):
    _write(f"{tmp_dir}/a b+c%20_2015.csv", "k,e,v\n1,(X),a\n2,,b\n")       # e is empty here
    _write(f"{tmp_dir}/b_2016.csv", "k,e,v\n3,c,\n4,d,(X)\n")              # and v here
    _write(f"{tmp_dir}/c_2017.csv", "v,k\nx,5\n")
    _write(f"{tmp_dir}/d_2018.csv", "k,e,v\n")
    by_file = merge_folder(spark, tmp_dir, by="position", drop_empty="file")
    assert by_file.columns == ["k", "v", "Year"]
    assert sorted(map(tuple, by_file.collect())) == [("1", "a", "2015"), ("2", "b", "2015"), ("3", "c", "2016"), ("4", "d", "2016"), ("x", "5", "2017")]
    named = merge_folder(spark, tmp_dir, drop_empty="file")
    assert named.columns == ["k", "v", "Year", "e"]
    assert sorted(map(str, named.select("k", "e", "v", "Year").collect())) == sorted(map(str, merge_folder(spark, tmp_dir).select("k", "e", "v", "Year").collect()))


def test_empty_columns_of_many_files_in_one_job(spark, tmp_dir):
    from raw2clean.operators.shape import FILE, null_sentinels, present_columns
    from pyspark.sql import functions as F
    for i in range(120):
        _write(f"{tmp_dir}/f{i:03}.csv", "a,b\n1,2\n" if i % 2 else "a,b\n1,\n")
    files = io.list_files(spark, tmp_dir)
    df = null_sentinels(io.read_group(spark, ["a", "b"], files), extra={FILE: F.col("_metadata.file_path")})
    parts, jobs = _jobs(spark, lambda: present_columns(df, files))
    assert [(c, len(f)) for c, f in parts] == [(["a"], 60), (["a", "b"], 60)] and jobs <= 4
