import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from sluice.functions import q
from sluice.operators import explain, models
from sluice.session import local_table, scratch_path


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(600):
        a, b, proto = float(rng.uniform(0, 10)), float(rng.uniform()), ["tcp", "udp", "icmp"][i % 3]
        rows.append((i, a, b, 1.0, proto, "DoS" if a > 6 else "Bot" if proto == "udp" else "BENIGN"))
    return local_table(spark, rows, "id bigint, a double, b double, const double, proto string, label string")


FEATURES = ["a", "b", "const", "proto"]


@pytest.fixture(scope="module")
def forest(data):
    return models.train_forest(data, features=FEATURES, trees=8, depth=5)


def test_forest_learns_and_repeats(data, forest):
    scored = models.score_batch(forest, data)
    assert scored.columns == [*data.columns, "predicted_label"]
    assert scored.where(q("label") != q("predicted_label")).count() < 15
    again = models.train_forest(data, features=FEATURES, trees=8, depth=5)
    assert models.score_batch(again, data).exceptAll(scored).count() == 0


def test_saved_model_predicts_the_same(spark, data, forest):
    path = models.save_model(forest, scratch_path(spark, "model"))
    loaded = models.load_model(path)
    assert models.score_batch(loaded, data).exceptAll(models.score_batch(forest, data)).count() == 0
    assert loaded.labels == ["BENIGN", "Bot", "DoS"] and [line.split() for line in models.mapping_lines(loaded.labels)[2:]] == [["BENIGN", ":", "0"], ["Bot", ":", "1"], ["DoS", ":", "2"]]
    assert models.read_mapping(spark, f"{path}/mapping").collect() == [("BENIGN", 0), ("Bot", 1), ("DoS", 2)]


def test_scoring_takes_missing_columns_and_new_texts(data, forest):
    other = data.drop("b", "label").withColumn("proto", F.lit("sctp")).withColumn("more", F.lit(1))
    assert models.score_batch(forest, other).count() == 600


def test_importance_and_pruning(data, forest):
    importance = models.feature_importance(forest)
    assert abs(importance.agg(F.sum("importance_pct")).first()[0] - 100) < 1e-9
    kept = models.prune_features(data, importance, 0.1).columns
    assert "const" not in kept and {"a", "proto", "label"} <= set(kept)


def test_contributions_add_up_to_the_probability(data, forest):
    rows = {r["id"]: r for r in explain.explain_rows(forest, data, "id", all_rows=True).collect()}
    scored = models._assembled(forest, data).select(q("_carry0").alias("id"), vector_to_array("_probability").alias("p"), "_prediction").collect()
    assert len(rows) == 600
    for r in scored:
        assert abs(rows[r["id"]]["base"] + sum(rows[r["id"]]["contributions"]) - r["p"][int(r["_prediction"])]) < 1e-9


def test_contributions_equal_the_definition():
    """Shapley values by enumerating all orders of two features of a small tree."""
    shares = [np.array([0.9, 0.1]), np.array([0.2, 0.8]), np.array([0.4, 0.6])]
    inf = np.inf
    tree = [(shares[0], [(0, -inf, 1.0, False, 0.5)]), (shares[1], [(0, 1.0, inf, False, 0.5), (1, -inf, 2.0, False, 0.25)]), (shares[2], [(0, 1.0, inf, False, 0.5), (1, 2.0, inf, False, 0.75)])]
    row = np.array([[3.0, 5.0]])

    def value(known):
        return sum(s[1] * np.prod([float(lo < row[0, f] <= hi) if f in known else share for f, lo, hi, _, share in path]) for s, path in tree)

    want = [((value({0}) - value(set())) + (value({0, 1}) - value({1}))) / 2, ((value({1}) - value(set())) + (value({0, 1}) - value({0}))) / 2]
    got, base = explain.contributions([tree], row, np.array([1]))
    assert np.allclose(got[0], want) and np.allclose(base, value(set()))


def test_one_sentence_per_class(data, forest):
    rows = explain.explain_predictions(forest, data, "id").collect()
    assert {r["predicted_label"] for r in rows} == {"BENIGN", "Bot", "DoS"}
    assert all(r["explanation"].startswith(f"{r['predicted_label']} predicted because: ") and r["explanation"].count(" was ") == 3 for r in rows)


def test_boosted(data):
    many = models.train_boosted(data, features=FEATURES, rounds=3, depth=3)
    assert models.score_batch(many, data).where(q("label") != q("predicted_label")).count() < 30
    two = models.train_boosted(data.where(q("label") != "Bot"), features=FEATURES, rounds=3, depth=3)
    assert set(two.labels) == {"BENIGN", "DoS"} and models.score_batch(two, data).count() == 600


def test_hold_out(data):
    _, scored = models.train_and_hold_out(data, models.train_forest, key="id", features=FEATURES, trees=3, depth=3)
    counts = {r["label"]: r["count"] for r in data.groupBy("label").count().collect()}
    want = sum(n - round(n * 0.8) for n in counts.values())
    assert scored.count() == want


def test_metrics_with_an_unseen_class(spark):
    df = local_table(spark, [("a", "a")] * 3 + [("a", "b"), ("b", "b")], "label string, predicted_label string")
    matrix = [tuple(r) for r in models.confusion_matrix(df, ["a", "b", "c"]).collect()]
    assert matrix == [("a", 3, 1, 0), ("b", 0, 1, 0), ("c", 0, 0, 0)]
    report = {r["label"]: (r["precision"], r["recall"], r["support"]) for r in models.classification_report(df, ["a", "b", "c"]).collect()}
    assert report["a"] == (1.0, 0.75, 4) and report["b"] == (0.5, 1.0, 1) and report["c"] == (0.0, 0.0, 0)
    assert report["accuracy"][0] == 0.8
    assert models.evaluate(df, ["a"]) is None and models.evaluate(df.drop("label"), ["a", "b"]) is None
    assert models.evaluate(df, ["a", "b"]) is not None


def test_encoded_features(spark, monkeypatch):
    df = local_table(spark, [("b",), ("a",), (None,), ("b",)], "t string")
    assert sorted(r["t"] for r in models.encode_features(df).where("t is not null").collect()) == [0, 1, 1]
    monkeypatch.setattr(models, "MAX_CATEGORIES", 1)
    assert sorted(r["t"] for r in models.encode_features(df).where("t is not null").collect()) == [0, 1, 1]


@pytest.mark.parametrize("train", [models.train_forest, models.train_boosted])
def test_models_do_not_depend_on_the_cluster_and_take_missing_values(spark, data, train):
    holes = data.withColumn("a", F.when(q("id") % 7 == 0, None).when(q("id") % 11 == 0, float("nan")).otherwise(q("a"))).where("label <> 'Bot'")
    options = {"trees": 10, "depth": 5} if train is models.train_forest else {"rounds": 5, "depth": 3}
    before, found = spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for n in ("3", "11"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            model = train(holes.repartition(int(n)), features=["a", "b"], **options)
            found.append(sorted(map(tuple, models.score_batch(model, holes).select("id", "predicted_label").collect())))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0] == found[1] and len({p for _, p in found[0]}) == 2


def test_training_partitions_follow_the_rows():
    """Tasks of the training stay small however many rows there are; small tables keep their models."""
    assert [models._training_partitions(n) for n in (0, 1000, 32 << 19, (32 << 19) + 1, 216_000_000)] == [32, 32, 32, 33, 412]


def test_first_rows_are_found_without_sorting_the_table(spark, data, forest):
    """Rows that cannot be the first of their class leave their batch before the sort; NULL keys come first."""
    table = data.withColumn("id", F.when(q("id") == 7, None).otherwise(F.concat(F.lit("k"), q("id").cast("string")))).repartition(3)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        found = explain.explain_rows(forest, table, "id")
        plan = found._jdf.queryExecution().executedPlan().toString()
        got = {r["predicted_label"]: r["id"] for r in found.collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert plan.index("MapInPandas") < plan.index("Window") < plan.index("Sort") < plan.index("MapInArrow")
    scored = [(r["predicted_label"], r["id"]) for r in models.score_batch(forest, table).select("predicted_label", "id").collect()]
    want = {label: min((i for c, i in scored if c == label), key=lambda v: (v is not None, v)) for label, _ in scored}
    assert got == want and None in want.values()
