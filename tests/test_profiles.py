import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from sluice.functions import q
from sluice.operators import profile, repair, rules, setops
from sluice.operators.quantiles import exact_quantiles
from sluice.session import local_table

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.integers(-5, 5), st.floats(-1e6, 1e6)), min_size=1, max_size=300))
def test_quantiles_equal_numpy(spark, values):
    df = local_table(spark, [(float(v),) for v in values], "x double")
    got = exact_quantiles(df, {"x": q("x")}, PROBS, accuracy=20, gather=10)["x"]
    assert np.allclose(got, np.quantile([float(v) for v in values], PROBS), rtol=1e-12)


def test_quantiles_with_a_hot_value(spark):
    x = F.when(q("id") % 3 == 0, 7.0).otherwise(F.pmod(F.xxhash64("id"), F.lit(100_003)).cast("double") / 1000)
    df = spark.range(200_000).select(x.alias("x"))
    want = np.quantile([r[0] for r in df.collect()], PROBS)
    assert np.allclose(exact_quantiles(df, {"x": q("x")}, PROBS, accuracy=100, gather=500)["x"], want)
    assert np.allclose(exact_quantiles(df, {"x": q("x")}, PROBS)["x"], want)


def test_quantiles_of_nothing(spark):
    df = local_table(spark, [(None,)], "x double")
    assert exact_quantiles(df, {"x": q("x")}, [0.5]) == {"x": [None]}


def test_sketched_dominance_equals_the_full_count(spark):
    value = F.when(q("id") % 10 < 6, "top").otherwise(q("id").cast("string"))
    df = spark.range(50_000).select(value.alias("a"), q("id").cast("string").alias("b"), F.when(q("id") % 2 == 0, "x").otherwise("y").alias("c"))
    full = profile.dominance(df).where(q("ratio") >= 0.5)
    assert sorted(map(tuple, profile.dominance(df, min_ratio=0.5).collect())) == sorted(map(tuple, full.collect()))
    assert {r["column"] for r in profile.dominance_report(df).select("column").distinct().collect()} == {"a", "c"}
    assert profile.dominant_columns(df, 0.55, 0.65).select("column", "n_unique").collect() == [("a", 20_001)]


def test_low_variance_finds_every_column(spark):
    df = spark.range(1000).select(*[(q("id") % n).cast("string").alias(f"c{n}") for n in (1, 2, 5, 6, 90, 1000)])
    assert {r["column"]: r["values"] for r in profile.low_variance_columns(df, 5).collect()} == {"c2": ["0", "1"], "c5": list("01234")}
    assert [tuple(r) for r in profile.constant_columns(df).collect()] == [("c1", "0")]


def test_outliers_ignore_infinite_quartiles(spark):
    df = local_table(spark, [(float(i), math.inf if i % 2 else 1.0) for i in range(20)] + [(1000.0, 1.0)], "x double, y double")
    assert [tuple(r) for r in profile.outlier_report(df).collect()] == [("x", 1)]
    assert profile.iqr_outliers(df).select("x", "outlier_columns").collect() == [(1000.0, ["x"])]


def test_histogram_of_many_and_few(spark):
    many = profile.histogram(spark.range(101).select(q("id").cast("double").alias("x")), "x")
    assert many.count() == 50 and many.agg(F.sum("n")).first()[0] == 101
    assert profile.histogram(spark.range(500).select((q("id") % 50).alias("x")), "x").count() == 50


def test_reports_of_an_empty_table(spark):
    df = local_table(spark, [], "a string, b double")
    assert profile.missing_report(df).count() == 0 and profile.inf_report(df).count() == 0
    assert profile.duplicate_count(df).collect() == [(0, 0)]
    assert profile.dominance(df, min_ratio=0.5).count() == 0 and profile.dominance(df).count() == 0


def test_impute(spark):
    rows = [(1.0, "inf", math.inf), (3.0, "x", -math.inf), (math.inf, "4", math.inf), (None, None, None)]
    df = local_table(spark, rows, "a double, b string, c double")
    got = repair.impute_inf(df).collect()
    assert [tuple(r) for r in got] == [(1.0, 4.0, None), (3.0, None, None), (2.0, 4.0, None), (None, None, None)]
    assert profile.inf_report(repair.impute_inf(df)).count() == 0
    assert repair.drop_inf_columns(df, 0.5).columns == ["a", "b"]


def test_fill_sentinel(spark):
    rows = [("Not a complete handshake", "1"), ("2", "not a complete handshake"), ("4", "5"), (None, "x")]
    df = local_table(spark, rows, "a string, b string")
    got = [tuple(r) for r in repair.fill_sentinel_with_median(df, ["a", "b"]).collect()]
    assert got == [(3.0, 1.0, 1), (2.0, 3.0, 1), (4.0, 5.0, 0), (3.0, 3.0, 0)]
    strict = repair.fill_sentinel_with_median(df, ["a", "b"], ignore_case=False)
    assert [r["handshake_incomplete"] for r in strict.collect()] == [0, 1, 0, 0]
    assert rules.drop_sentinel_rows(df, ["a", "b"]).count() == 4 and rules.drop_sentinel_rows(df, ["a", "b"], how="any").count() == 2


def test_repairs_in_one_go_equal_the_single_steps(spark):
    rows = [(1.0, "inf", "not a complete handshake"), (math.inf, "3", "2"), (5.0, "not a complete handshake", "9"), (4.0, "8", "inf"), (6.0, None, "1")]
    df = local_table(spark, rows, "a double, s string, t string")
    flag = repair.fill_sentinel_with_median(df, ["s", "t"]).select("handshake_incomplete").collect()
    fused = repair.repair_numbers(df, ["s", "t"])
    single = repair.fill_sentinel_with_median(repair.impute_inf(df), ["s", "t"])
    assert fused.drop("handshake_incomplete").collect() == single.drop("handshake_incomplete").collect()
    assert fused.select("handshake_incomplete").collect() == flag


def test_set_differences(spark, monkeypatch):
    a = local_table(spark, [(1, None)] * 5 + [(2, "x")] * 2 + [(3, "y")], "k int, v string")
    b = local_table(spark, [(1, None)] * 2 + [(4, "z")], "kk int, vv string")
    assert sorted(map(tuple, setops.missing_rows(a, b).collect())) == [("2", "x"), ("3", "y")]
    assert setops.missing_rows(a, b, multiset=True).groupBy("k").count().orderBy("k").collect() == [("1", 3), ("2", 2), ("3", 1)]
    assert setops.extra_rows(a, b).collect() == [("4", "z")]
    assert tuple(setops.compare_tables(a, b).first()) == (3, 2, 2, 1, False)
    assert setops.compare_tables(a, a).first()["same"] is True
    with pytest.raises(ValueError):
        setops.union_positional([a, b])


def test_digests_tell_rows_apart(spark):
    nan = float("nan")
    rows = [(None, "a", 0.0), ("a", None, 0.0), ("a", "a", -0.0), ("a", "a", 0.0), ("aa", "", nan), ("", "aa", nan), ("", "aa", nan), (None, None, None), (None, None, None)]
    df = local_table(spark, rows, "a string, b string, c double")
    assert profile.duplicate_count(df).first() == (9, 3) and setops.distinct_rows(df).first()[0] == 6
    by = {r["a"]: (r["n_rows"], r["n_duplicates"]) for r in profile.duplicate_count(df, "a").collect()}
    assert by == {None: (3, 1), "a": (3, 1), "aa": (1, 0), "": (2, 1)}
    kept = setops.missing_rows(df, df.limit(0)).collect()
    assert len(kept) == 7  # as text, -0.0 and 0.0 differ
    with pytest.raises(ValueError):
        setops.missing_rows(df, df.select("a"))


def test_counting_and_comparing_move_digests_only(spark):
    """No column of the table passes an exchange, and a row costs less than 24 bytes of shuffle."""
    df = spark.range(200_000).select(*[F.sha2(F.concat(F.lit(str(i)), q("id").cast("string")), 256).alias(f"c{i}") for i in range(6)])
    for counted in (profile.duplicate_count(df), setops.distinct_rows(df), setops.compare_tables(df, df.limit(1000))):
        plan = counted._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(_d1" in plan and not any(f"hashpartitioning(c{i}" in plan for i in range(6))
        assert all("c0" not in line for line in plan.splitlines() if "HashAggregate" in line)
    before = {s.stageId() for s in _stages(spark)}
    setops.distinct_rows(df).collect()
    assert 0 < sum(s.shuffleWriteBytes() for s in _stages(spark) if s.stageId() not in before) < 24 * 200_000


def _stages(spark):
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    some = jvm.java.util.ArrayList()
    listed = spark.sparkContext._jsc.sc().statusStore().stageList(some, False, False, gateway.new_array(jvm.double, 0), some)
    return [listed.apply(i) for i in range(listed.size())]


def test_differences_with_many_rows(spark, monkeypatch):
    """More differing rows than are broadcast, copies, and clashing order of columns."""
    a = spark.range(3000).select((q("id") % 2500).alias("k"), F.concat(F.lit("v"), q("id") % 2500).alias("v"))
    b = spark.range(1000).select(q("id").alias("x"), F.concat(F.lit("v"), q("id")).alias("y"))
    want = {(str(i), f"v{i}") for i in range(1000, 2500)}
    assert set(map(tuple, setops.missing_rows(a, b).collect())) == want
    monkeypatch.setattr(setops, "small_table", lambda df: (df, None))
    assert set(map(tuple, setops.missing_rows(a, b).collect())) == want
    assert setops.missing_rows(a, b, multiset=True).count() == 1500 + 500 and setops.extra_rows(a, b).count() == 0


def test_routing_takes_whole_groups(spark):
    df = local_table(spark, [("f1", "BENIGN"), ("f1", "DoS"), ("f2", "DoS"), ("f3", None)], "file string, label string")
    got = rules.route_by_group(df, "file", F.lower("label") == "benign").orderBy("file", "label")
    assert [r["route"] for r in got.collect()] == ["benign", "benign", "attack", "attack"]


def test_names_that_differ_in_case_are_columns_of_their_own(spark):
    from sluice.operators import columns
    df = local_table(spark, [(1, "a", "b")], "id int, Label string, label string")
    assert columns.drop_columns(df, ["Label"]).columns == ["id", "label"]
    assert columns.drop_columns(df, ["Label"]).collect() == [(1, "b")]


def test_long_texts_are_not_broadcast(spark):
    from sluice.session import small_table
    df = local_table(spark, [(i, "x" * 1000) for i in range(20)], "id int, t string")
    assert small_table(df, max_bytes=10_000)[1] is None and len(small_table(df)[1]) == 20
