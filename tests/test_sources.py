import os
import time

import pytest
from pyspark.sql import functions as F, types as T

from sluice import sources
from sluice.functions import q
from sluice.operators import sampling
from sluice.session import local_table, scratch_path, small_table
from sluice.sources import readers


@pytest.fixture()
def folder(tmp_path):
    (tmp_path / "sub dir").mkdir()
    (tmp_path / "a.csv").write_text('id,label,v\n1,x,"a,""b"""\n2,y,\n')
    (tmp_path / "b.csv").write_text("id,v,extra\n3,c,e\n")
    (tmp_path / "sub dir" / "c+d.csv").write_text("a,b,a, Label,x.y,x.z\n1,2,3,B,4,5\n")
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "notes.txt").write_text("id\n9\n")
    return str(tmp_path)


def test_headers(spark, folder):
    got = {r["filename"]: [r[f"title_{i}"] for i in range(1, 7)] for r in sources.header_inventory(spark, folder).collect()}
    assert got == {"a.csv": ["id", "label", "v", "", "", ""], "b.csv": ["id", "v", "extra", "", "", ""],
                   "c+d.csv": ["a", "b", "a", " Label", "x.y", "x.z"]}
    flat = sources.schema_conformance(spark, ["id", "label", "v"], folder, recursive=False)
    assert {r["filename"] for r in flat.where(F.size("names") > 0).collect()} == {"b.csv"}


def test_folder_by_name(spark, folder):
    df = sources.read_folder(spark, folder)
    assert set(df.columns) == {"id", "label", "v", "source_file", "extra", "a", "b", "a.1", " Label", "x.y", "x.z"}
    rows = {(r["id"], r["v"], r["extra"], r["source_file"]) for r in df.collect()}
    assert rows == {("1", 'a,"b"', None, "a.csv"), ("2", None, None, "a.csv"), ("3", "c", "e", "b.csv"), (None, None, None, "c+d.csv")}
    assert sources.read_folder(spark, folder, exclude="^(b|c)").count() == 2
    assert sources.read_folder(spark, folder, recursive=False, align="position", include_glob="a*.csv").count() == 2


def test_bad_lines(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,v\n1,2.5\nx,1.0\n2,\n3,4.0,9\n4\n")
    checked = sources.read_checked(spark, str(tmp_path), T.StructType.fromDDL("id bigint, v double"))
    good, bad = sources.rejected_rows(checked)
    assert [tuple(r) for r in good.collect()] == [(1, 2.5), (2, None)]
    assert sorted(r["_corrupt_record"] for r in bad.collect()) == ["3,4.0,9", "4", "x,1.0"]


def test_one_file_and_many(spark, tmp_path):
    df = spark.range(100).select("id", F.lit('q"x').alias("t"))
    one = sources.write_table(df, f"{tmp_path}/report.csv", single_file=True)
    assert open(one).read().startswith("id,t\n0,")
    sources.write_table(df.limit(1), one, single_file=True)
    assert sources.read_table(spark, one).collect() == [("0", 'q"x')]
    many = sources.write_table(df, f"{tmp_path}/many", partitions=20)
    assert sources.with_source(sources.read_table(spark, many), "f").select("f").distinct().count() == 20


def test_typed_and_pruned(spark, tmp_path):
    sources.write_table(spark.range(5).select("id", (q("id") / 2).alias("h")), f"{tmp_path}/t")
    assert [t for _, t in sources.read_table(spark, f"{tmp_path}/t", "infer").dtypes] == ["int", "double"]
    pruned = sources.read_table(spark, f"{tmp_path}/t", columns=["h"])
    assert "ReadSchema: struct<h:string>" in pruned._jdf.queryExecution().executedPlan().toString()


def test_part_files_hold_one_part_each(spark):
    df = spark.range(1000).select("id", F.when(q("id") % 10 == 0, "BENIGN").when(q("id") % 3 == 0, "Web Attack – 1").otherwise("DoS").alias("label"))
    parts = sampling.bounded_parts(df, benign_rows=30, attack_rows=250, key="id", shuffle_seed=1)
    groups = ["status", "class", "label_name", "part"]
    path = sources.write_parts_by_group(parts, scratch_path(spark, "parts"), groups)
    back = sources.with_source(sources.read_table(spark, path), "file")
    sizes = back.groupBy(*groups).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("file").alias("files")).collect()
    assert all(r["files"] == 1 for r in sizes) and sum(r["n"] for r in sizes) == 1000
    assert max(r["n"] for r in sizes if r["class"] == "benign") == 30 and max(r["n"] for r in sizes) == 250


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_local_table_keeps_times(spark, monkeypatch, zone):
    monkeypatch.setenv("TZ", zone)
    time.tzset()
    try:
        df = spark.sql("SELECT timestamp'2024-03-01 00:30:00' AS t, timestamp_ntz'2024-03-01 00:30:00' AS n, named_struct('t', timestamp'2024-07-01 00:30:00') AS s")
        local, rows = small_table(df)
        assert len(rows) == 1 and local.exceptAll(df).count() == 0
    finally:
        monkeypatch.undo()
        time.tzset()


def test_local_table_keeps_nested_values(spark):
    df = local_table(spark, [([1.0, None], {"x": "p", "y": 1}), (None, None)], "a array<double>, s struct<x:string,y:int>")
    assert df.collect() == [([1.0, None], ("p", 1)), (None, None)]


def test_long_headers_are_whole(spark, tmp_path):
    names = [f"column_{i:06d}_{'x' * 300}" for i in range(5000)]
    (tmp_path / "wide.csv").write_text(",".join(names) + "\n" + ",".join("1" for _ in names) + "\n")
    row = readers.header_list(spark, str(tmp_path)).first()
    assert row["names"] == names and row["reason"] is None


def test_cut_files_are_left_out_whole_or_fail(spark, tmp_path):
    import gzip
    text = "a,b\n" + "".join(f"{i},{i * 7919 % 10007}\n" for i in range(50_000))
    packed = gzip.compress(text.encode())
    (tmp_path / "good.csv.gz").write_bytes(packed)
    (tmp_path / "cut.csv.gz").write_bytes(packed[:len(packed) // 2])
    (tmp_path / "plain.csv").write_text("b,a\n1,2\n")
    found = sources.read_folder(spark, str(tmp_path), include_glob="*.csv*")
    assert found.count() == 50_001 and found.where("source_file = 'cut.csv.gz'").count() == 0
    bad = sources.unreadable_files(spark, str(tmp_path), include_glob="*.csv*").collect()
    assert [r["filename"] for r in bad] == ["cut.csv.gz"] and bad[0]["reason"]
    with pytest.raises(OSError):
        sources.read_folder(spark, str(tmp_path), include_glob="*.csv*", on_error="fail")
    with pytest.raises(FileNotFoundError):
        sources.read_folder(spark, str(tmp_path), include_glob="*.none")


def test_csv_options_hold_for_headers_and_rows(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes('x;"y z"\n"one\ntwo";é\n'.encode("latin-1"))
    df = sources.read_folder(spark, str(tmp_path), source_col=None, sep=";", multiLine=True, encoding="iso-8859-1")
    assert df.columns == ["x", "y z"] and [tuple(r) for r in df.collect()] == [("one\ntwo", "é")]


def test_csv_keeps_spaces_breaks_and_empty_texts(spark, tmp_path):
    values = [" a ", 'say "x", y', "two\nlines", "", None, " "]
    df = local_table(spark, [(i, v) for i, v in enumerate(values)], "id int, ` Label` string")
    path = sources.write_table(df, str(tmp_path / "t"))
    back = sources.read_table(spark, path, df.schema, multiLine=True, nullValue="\0")
    assert [r[1] for r in back.orderBy("id").collect()] == values and back.columns == ["id", " Label"]


@pytest.mark.parametrize("way", ["ranges", "store", "buffer"])
def test_parts_are_joined_under_one_header(spark, tmp_path, monkeypatch, way):
    """By tasks that copy ranges, by a store that can join, and through a buffer; no stage gets all rows in one task."""
    from sluice.sources import writers
    monkeypatch.setattr(writers, "COPY_BYTES", 1000)

    class Joining:
        """A store that can append files to one that is there."""
        def __init__(self, system):
            self.system = system

        def hasPathCapability(self, path, name):
            return name == "fs.capability.paths.concat"

        def concat(self, first, rest):
            with open(first.toUri().getPath(), "ab") as out:
                for p in rest:
                    out.write(open(p.toUri().getPath(), "rb").read())
                    self.system.delete(p, False)
            os.unlink(os.path.join(os.path.dirname(out.name), f".{os.path.basename(out.name)}.crc"))

        def __getattr__(self, name):
            return getattr(self.system, name)

    if way != "ranges":
        def join(session, system, hadoop, pieces, whole):
            writers._joined(session, Joining(system) if way == "store" else system, [p for p, _ in pieces], whole)
        monkeypatch.setattr(writers, "_copied", join)
    df = spark.range(2000).select("id", F.concat(F.lit('a "b", '), q("id").cast("string"), F.when(q("id") % 7 == 0, "\nnext").otherwise("")).alias("x y,z"), F.lit(None).cast("string").alias("n"))
    path = writers.merge_parts(df, f"{tmp_path}/with space/one.csv", parts=10)
    with open(path, newline="") as file:
        text = file.read()
    assert text.count("x y,z") == 1 and text.startswith('id,"x y,z",n') and len(os.listdir(os.path.dirname(path))) <= 2
    back = sources.read_table(spark, path, df.schema, fmt="csv", multiLine=True)
    assert back.exceptAll(df).count() == 0 and back.count() == 2000
    before = os.path.getsize(path)
    writers.merge_parts(df, path, parts=3)
    assert os.path.getsize(path) == before
    assert sources.read_table(spark, writers.merge_parts(df.limit(0), path), df.schema, fmt="csv").count() == 0
    lines = writers.merge_parts(df.select(q("id").cast("string")), f"{tmp_path}/ids.txt", "text", 5)
    assert sorted(map(int, open(lines).read().split())) == list(range(2000))
    with pytest.raises(ValueError):
        writers.merge_parts(df, f"{tmp_path}/x", "parquet")


def test_many_files_of_few_layouts_are_one_scan(spark, tmp_path):
    """5,000 files of three layouts: one scan in the plan, and the driver gets layouts, not paths."""
    heads = ["a,b", "b,a,a", "c,b"]
    for i in range(5000):
        (tmp_path / f"f{i:04d}.csv").write_text(f"{heads[i % 3]}\n{i},{-i}{',7' if i % 3 == 1 else ''}\n")
    df = sources.read_folder(spark, str(tmp_path))
    assert df.columns == ["a", "b", "a.1", "c", "source_file"]
    assert df._jdf.queryExecution().optimizedPlan().toString().count("csv") == 1
    got = df.selectExpr("cast(substr(source_file, 2, 4) as int) i", "a", "b", "`a.1`", "c").collect()
    want = [(i, *[(str(i), str(-i), None, None), (str(-i), str(i), "7", None), (None, str(-i), None, str(i))][i % 3]) for i in range(5000)]
    assert sorted(map(tuple, got)) == want


@pytest.fixture()
def mounted(spark, tmp_path):
    """The folder under a name that only Spark's file systems know."""
    conf = spark._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.sources.link./in", f"file://{tmp_path}")
    return "viewfs://sources/in"


def test_stores_that_only_spark_opens(spark, tmp_path, folder, mounted):
    import gzip
    text = "b,id\n" + "".join(f"{i},{i * 7919 % 10007}\n" for i in range(50_000))
    packed = gzip.compress(text.encode())
    (tmp_path / "good.csv.gz").write_bytes(packed)
    (tmp_path / "cut.csv.gz").write_bytes(packed[:len(packed) // 2])
    (tmp_path / "q.csv").write_bytes(('﻿"two\nlines",id\n' + "x,9\n" * 30_000).encode())
    near, far = (readers.header_list(spark, p, include_glob="*.csv*").selectExpr("filename", "names", "reason is null as good").collect() for p in (folder, mounted))
    assert sorted(near) == sorted(far) and len(far) == 6 and [r["filename"] for r in far if not r["good"]] == ["cut.csv.gz"]
    assert ["two\nlines", "id"] in [r["names"] for r in far]
    there = [sources.read_folder(spark, p, include_glob="*.csv*", exclude="^q").orderBy("source_file", "id", "b") for p in (folder, mounted)]
    assert there[0].columns == there[1].columns and there[0].collect() == there[1].collect() and there[1].count() == 50_004
    assert sources.schema_conformance(spark, ["id", "v", "extra"], mounted, include_glob="b*.csv").count() == 0


def test_strict_modes_judge_rows_by_their_own_header(spark, folder):
    kept = sources.read_folder(spark, folder, mode="DROPMALFORMED")
    assert sorted(r["source_file"] for r in kept.collect()) == ["a.csv", "a.csv", "b.csv", "c+d.csv"]
