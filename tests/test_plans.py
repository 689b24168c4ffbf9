import numpy as np
from pyspark.sql import functions as F

from __spark_entry__ import HANDSHAKE, flows
from sluice import plans
from sluice.functions import q
from sluice.operators import profile
from sluice.session import local_table, scratch_path
from sluice.sources import read_table, write_table
from sluice.streaming import prepare_stream

SF = "/root/testdata/sf0.001"


def test_audit_and_clean(spark):
    df = flows(spark, SF)
    reports = plans.audit(df)
    assert {r["column"] for r in reports["constant"].collect()} == {"proto"}
    assert {r["column"] for r in reports["infinite"].collect()} == {"bytes_rate", "idle_max", "mixed_val"}
    clean = plans.clean_table(df, HANDSHAKE, ["proto"])
    assert "idle_max" not in clean.columns and "proto" not in clean.columns
    assert profile.inf_report(clean).count() == 0
    assert clean.where("flow_duration < 0 or delta_start is null or handshake_duration is null").count() == 0


def test_merge_keeps_every_row(spark, tmp_path):
    for i in range(3):
        write_table(spark.range(10 * (i + 1)).select("id", F.lit(f"f{i}").alias("f")), f"{tmp_path}/in/part{i}")
    merged = plans.merge_folder(spark, f"{tmp_path}/in", f"{tmp_path}/out", partitions=4)
    out = read_table(spark, f"{tmp_path}/out")
    assert out.count() == 60 and out.exceptAll(merged).count() == 0


def test_missing_parts(spark):
    path = scratch_path(spark, "missing")
    plans.missing_parts(flows(spark, SF), path, key="row_id", delete_for=["Bot"], benign_rows=100, attack_rows=200)
    back = read_table(spark, path)
    assert {r[0] for r in back.select("status").distinct().collect()} == {"Missing", "NoMissing"}
    assert back.where("label = 'Bot' and status = 'Missing'").count() == 0
    assert back.groupBy("status", "label_name", "part").count().agg(F.max("count")).first()[0] == 200


def test_balance_train_score(spark):
    rng = np.random.default_rng(0)
    rows = [(i, float(rng.normal(i % 10 == 0) * 1.0 + 3 * (i % 10 == 0)), float(rng.normal()), "Bot" if i % 10 == 0 else "BENIGN") for i in range(200)]
    df = local_table(spark, rows, "ID bigint, `X ` double, y double, Label string")
    model, scored = plans.balance_train_score(df, df.drop("y"), ["x", "y"], "id", trees=5, depth=4)
    assert model.labels == ["BENIGN", "Bot"] and scored.columns == ["x", "y", "label", "predicted_label"]
    assert scored.where(q("label") == q("predicted_label")).count() > 170


def test_stream_equals_table(spark, tmp_path):
    source = write_table(flows(spark, SF), f"{tmp_path}/flows", "parquet")
    table = read_table(spark, source, "infer", fmt="parquet")
    stream = prepare_stream(spark.readStream.schema(table.schema).parquet(source), drop=["proto"], sentinel_columns=HANDSHAKE)
    query = stream.writeStream.format("memory").queryName("prepared").outputMode("append").option("checkpointLocation", f"{tmp_path}/cp").start()
    query.processAllAvailable()
    query.stop()
    want = prepare_stream(table, drop=["proto"], sentinel_columns=HANDSHAKE)
    got = spark.table("prepared")
    assert got.count() == want.count() > 0 and got.exceptAll(want).count() == 0
