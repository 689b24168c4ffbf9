import hashlib

import pytest
from pyspark.sql import Window as W, functions as F

from sluice.functions import half_even, q
from sluice.operators import ranking, sampling
from sluice.session import local_table, small_table


def skewed(spark, n=3000):
    """Two thirds of the rows carry one label, some none."""
    label = F.when(q("id") % 3 < 2, "big").when(q("id") % 7 == 0, None).otherwise(F.concat(F.lit("l"), (q("id") % 5).cast("string")))
    return spark.range(n).select(q("id"), label.alias("label"), F.concat(F.lit("key-"), F.lpad(q("id").cast("string"), 6, "0")).alias("text"),
                                 F.timestamp_seconds(q("id") * 977 % 10007).alias("at"))


@pytest.mark.parametrize("key,seed", [("id", None), ("text", None), (["at", "id"], None), ("id", 7)])
def test_row_numbers_equal_a_plain_window(spark, key, seed):
    df = skewed(spark)
    keys = [key] if isinstance(key, str) else key
    order = [F.md5(F.concat_ws(":", F.lit("7"), q("id").cast("string")))] if seed else [q(k) for k in keys]
    plain = df.withColumn("want", F.row_number().over(W.partitionBy("label").orderBy(*order)))
    got = ranking.number_rows(df, "label", key, seed, out="rn", total="n", rows_per_cell=100)
    assert got.join(plain, "id").where(q("rn") != q("want")).count() == 0
    assert got.count() == df.count()
    assert got.where(q("label") == "big").select("n").distinct().collect() == [(2000,)]


def test_large_groups_are_divided(spark):
    o = ranking.ordered(skewed(spark), "label", "id", None, rows_per_cell=100)
    assert o.df.groupBy(*o.group, "_cell").count().agg(F.max("count")).first()[0] <= 150
    o = ranking.ordered(skewed(spark), "label", "id", 42)
    assert o.df.groupBy(*o.group, "_cell").count().agg(F.max("count")).first()[0] <= 30


def test_equal_rows_get_different_numbers(spark, monkeypatch):
    monkeypatch.setattr(ranking, "COPY_BLOCK", 64)
    df = spark.range(1000).select(F.when(q("id") % 3 == 0, "x").otherwise((q("id") % 50).cast("string")).alias("v"))
    got = ranking.number_rows(df, (), None, 1, out="rn")
    assert sorted(r["rn"] for r in got.collect()) == list(range(1, 1001))
    assert got.groupBy("v").count().exceptAll(df.groupBy("v").count()).count() == 0
    taken = ranking.take_first(df, (), F.lit(333), None, 1, out="t")
    assert taken.where("t").count() == 333 and taken.count() == 1000


def test_unclear_key_is_refused(spark):
    df = spark.range(100).select((q("id") % 2).alias("k"))
    with pytest.raises(ValueError):
        ranking.take_first(df, (), F.lit(30), "k", 1)


@pytest.mark.parametrize("parts", [1, 7, 64])
def test_partitioning_does_not_matter(spark, parts):
    df = skewed(spark).drop("text", "at")
    want = sampling.stratified_split(df, 0.6, key="id", seed=3)
    got = sampling.stratified_split(df.repartition(parts), 0.6, key="id", seed=3)
    assert want.exceptAll(got).count() == 0 and got.count() == df.count()
    order = [r[0] for r in sampling.shuffle(df.repartition(parts), "id", 5).collect()]
    assert order == sorted(range(3000), key=lambda i: hashlib.md5(f"5:{i}".encode()).hexdigest())


def test_split_sizes_round_half_even(spark):
    rows = [("one",)] + [("two",)] * 2 + [("five",)] * 5 + [(None,)] * 3
    df = local_table(spark, [(i, *r) for i, r in enumerate(rows)], "id int, label string")
    split = sampling.stratified_split(df, 0.5, key="id")
    got = {(r["label"], r["split"]): r["count"] for r in split.groupBy("label", "split").count().collect()}
    assert got == {("one", "test"): 1, ("two", "train"): 1, ("two", "test"): 1, ("five", "train"): 2, ("five", "test"): 3,
                   (None, "test"): 2, (None, "train"): 1}
    assert split.select(half_even(F.lit(2.5))).first()[0] == 2


def test_downscale_keeps_attacks(spark):
    df = skewed(spark).select("id", F.when(q("label") == "big", "BENIGN").otherwise(q("label")).alias("label"))
    kept = sampling.downscale(df, 0.1, key="id")
    assert kept.where(q("label") == "BENIGN").count() == 200
    assert kept.count() == 200 + 1000


def test_shuffle_by_label_alternates(spark):
    df = skewed(spark).select("id", "label")
    labels = [r["label"] for r in sampling.shuffle_by_label(df, key="id").limit(12).collect()]
    n = df.where("label is not null").select("label").distinct().count()
    assert labels[:n] == sorted(set(labels[:n])) and labels[n:2 * n] == labels[:n]


def test_parts_are_bounded(spark):
    df = skewed(spark).select("id", "label")
    parts = sampling.bounded_parts(df, benign_rows=100, attack_rows=150, key="id", separate="none")
    sizes = parts.groupBy("label", "part").count().collect()
    assert max(r["count"] for r in sizes) == 150
    assert len([r for r in sizes if r["label"] == "big"]) == 14
    assert sampling.bounded_parts(df, attack_rows=0, key="id").count() == 0


def test_repeated_keys_are_refused_at_any_number_of_groups(spark, monkeypatch):
    from sluice.operators import ranking
    df = spark.range(3000).select((F.col("id") / 3).cast("bigint").alias("g"), F.lit(1).alias("k"))
    for most in (100_000, 10):
        monkeypatch.setattr(ranking, "small_table", lambda t, n=most: small_table(t, n))
        with pytest.raises(ValueError):
            ranking.take_first(df, "g", F.lit(1), key="k", seed=1).count()


def test_infinite_and_nan_keys(spark):
    from sluice.operators.ranking import number_rows
    values = [float("-inf")] * 300 + [float("inf")] * 300 + [float("nan")] * 300 + [float(i) for i in range(100)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id bigint, v double")
    got = {r["id"]: r["rn"] for r in number_rows(df, (), ["v", "id"], rows_per_cell=50).collect()}
    want = [r["id"] for r in df.orderBy("v", "id").collect()]
    assert [got[i] for i in want] == list(range(1, 1001))


def test_many_labels_are_numbered_like_few(spark, monkeypatch):
    from sluice.operators import columns
    df = spark.range(500).select(F.concat(F.lit("l"), F.col("id") % 97).alias("label"))
    few = sorted(map(tuple, columns.label_index(df).collect()))
    monkeypatch.setattr(columns, "small_table", lambda t, n=10: small_table(t, n))
    assert sorted(map(tuple, columns.label_index(df).collect())) == few


@pytest.mark.parametrize("key", [["day", "id"], ["url"]])
def test_no_cell_is_hot(spark, key):
    df = spark.range(20_000).select("id", F.lit("2020-01-01").alias("day"), F.concat(F.lit("https://example.org/a/long/common/path/"), F.md5(F.col("id").cast("string"))).alias("url"))
    df = df.unionByName(local_table(spark, [(-1, None, "a")], "id bigint, day string, url string"))
    cells = ranking.ordered(df, (), key, None, rows_per_cell=1000).df.groupBy("_cell").count().collect()
    assert max(r["count"] for r in cells) <= 2000 and len(cells) > 15
    got = {r["id"]: r["rn"] for r in ranking.number_rows(df, (), key, rows_per_cell=1000).collect()}
    assert [got[r["id"]] for r in df.orderBy(*key).collect()] == list(range(1, 20_002))


def test_copies_are_numbered_once_for_a_selection(spark):
    """Without a key, the table is shuffled once to number its copies, and the flags are read from what was written then."""
    df = local_table(spark, [(i % 40, "a" if i % 3 else "b") for i in range(300)], "x bigint, g string")
    flagged = ranking.take_first(df, "g", F.lit(30), key=None, seed=5)
    plan = flagged._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and "hashpartitioning" not in plan
    assert {r["g"]: (r["n"], r["t"]) for r in flagged.groupBy("g").agg(F.count("x").alias("n"), F.count_if("taken").alias("t")).collect()} == {"a": (200, 30), "b": (100, 30)}
    numbered = ranking.number_rows(df, "g", key=None, seed=5, out="rn")
    assert numbered.where("rn <= 30").drop("rn").exceptAll(flagged.where("taken").drop("taken")).count() == 0
