import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from sluice.functions import q
from sluice.operators import forest, models
from sluice.session import local_table


def drawn(n, seed=1):
    """Three labels by two features with noise, a third feature that says nothing, and the label of some rows changed."""
    rng = np.random.default_rng(seed)
    x = np.stack([rng.uniform(0, 10, n), np.floor(rng.uniform(0, 6, n)), rng.normal(size=n)], axis=1)
    y = (x[:, 0] > 4).astype(int) + (x[:, 1] > 2)
    return x, np.where(rng.uniform(size=n) < 0.1, rng.integers(0, 3, n), y)


def table_of(spark, x, y):
    return local_table(spark, [(*map(float, r), float(t)) for r, t in zip(x, y)], "a double, b double, c double, target double")


def trained(spark, x, y, **options):
    return forest.train(table_of(spark, x, y), ["a", "b", "c"], "target", int(y.max()) + 1, **options)


def test_as_good_as_that_of_spark(spark):
    """Held-out accuracy and importance beside Spark ML's forest with the same parameters."""
    (x, y), (other, truth) = drawn(3000), drawn(1500, 2)
    assembler = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features")
    theirs = RandomForestClassifier(labelCol="target", numTrees=20, maxDepth=6, seed=1).fit(assembler.transform(table_of(spark, x, y)))
    grown, cuts = trained(spark, x, y, trees=20, depth=6)
    ours = forest.as_model(spark, grown, cuts, 3, 6, 42, {})
    test = assembler.transform(table_of(spark, other, truth))
    right = [m.transform(test).where("prediction = target").count() / 1500 for m in (ours, theirs)]
    assert right[0] > right[1] - 0.01 and right[0] > 0.9
    assert np.abs(ours.featureImportances.toArray() - theirs.featureImportances.toArray()).max() < 0.15
    assert ours.getNumTrees == 20 and ours.numClasses == 3 and ours.numFeatures == 3


def test_nodes_hold_what_reaches_them(spark):
    """Each node's counts are the draws of the rows that reach it, its gain is that of Gini, and merged leaves differ."""
    x, y = drawn(500, 3)
    grown, cuts = trained(spark, x, y, trees=3, depth=4)
    assert [len(c) for c in cuts] == [31, 5, 31]
    for tree in grown:
        assert tree.stats[0].sum() == pytest.approx(500, abs=120)
        nodes = forest._nodes(tree, cuts)
        assert [n["id"] for n in nodes] == list(range(len(nodes)))
        for node in nodes:
            if node["leftChild"] < 0:
                continue
            left, right = nodes[node["leftChild"]], nodes[node["rightChild"]]
            assert np.allclose(np.add(left["impurityStats"], right["impurityStats"]), node["impurityStats"])
            below = [n["rawCount"] / node["rawCount"] * n["impurity"] for n in (left, right)]
            assert node["gain"] == pytest.approx(node["impurity"] - sum(below)) and node["gain"] > 0
            assert left["prediction"] != right["prediction"] or left["leftChild"] >= 0 or right["leftChild"] >= 0


def test_best_splits_equal_a_search(spark):
    rng = np.random.default_rng(5)
    sums = rng.integers(0, 4, (6, 2, forest.BINS, 3)).astype(float)
    sums[:, 1] = sums[:, 0][:, rng.permutation(forest.BINS)]
    sums[5] = 0
    sums[5, :, 3, 1] = 7
    features, sizes = np.array([[0, 2]] * 6), np.array([31, 31, 9])
    for node, (gain, f, b, left) in enumerate(forest.best_splits(sums, features, sizes)):
        total, best = sums[node, 0].sum(axis=0), 0.0
        for j in range(2):
            for i in range(sizes[features[node, j]]):
                one = sums[node, j, :i + 1].sum(axis=0)
                two = total - one
                if one.sum() and two.sum():
                    best = max(best, float(forest.gini(total) - (one.sum() * forest.gini(one) + two.sum() * forest.gini(two)) / total.sum()))
        assert gain == pytest.approx(best)
        if gain:
            assert left.tolist() == sums[node, features[node].tolist().index(f), :b + 1].sum(axis=0).tolist()


def test_rows_keep_nothing_per_tree(spark, monkeypatch):
    """What is kept between passes is one row per (bins, label), whatever the number of rows and of trees."""
    x, y = drawn(400, 5)
    x = np.round(x)
    sizes, written = {}, forest.written
    monkeypatch.setattr(forest, "written", lambda df, name: (sizes.setdefault(name, df.agg(F.sum(F.length("bins"))).first()[0]), written(df, name))[1])
    grown, _ = trained(spark, np.tile(x, (8, 1)), np.tile(y, 8), trees=30, depth=3)
    assert sizes["counted"] == sizes["blocks"] <= 400 * 3
    drawn_rows = np.array([tree.stats[0].sum() for tree in grown])
    assert abs(drawn_rows.mean() - 3200) < 60 and 25 < drawn_rows.std() < 110


def test_draws_are_those_of_a_bootstrap():
    counts = np.repeat([1, 3, 40, 5000], 20000)
    found = forest.draws(7, (0, 1), 2, counts).reshape(4, -1)
    for n, got in zip((1, 3, 40, 5000), found):
        assert abs(got.mean() - n) < 5 * np.sqrt(n / 20000) and abs(got.var() / n - 1) < 0.06
    assert (forest.draws(7, (0, 1), 3, counts) != found.ravel()).any() and (forest.draws(7, (0, 1), 2, counts) == found.ravel()).all()


def test_small_passes_and_blocks_give_the_same_model(spark, monkeypatch):
    x, y = drawn(700, 6)
    want, _ = trained(spark, x, y, trees=2, depth=4)
    monkeypatch.setattr(forest, "HISTOGRAM_BYTES", 5000)
    monkeypatch.setattr(forest, "DIRECT", 0)
    got, _ = trained(spark, x, y, trees=2, depth=4)
    assert [(t.feature, t.split, t.gain) for t in got] == [(t.feature, t.split, t.gain) for t in want]
    monkeypatch.setattr(forest, "BLOCK_ROWS", 100)
    monkeypatch.setattr(forest, "LEAST_BLOCK_ROWS", 300)
    monkeypatch.setattr(forest, "HISTOGRAM_BYTES", 8 << 20)
    blocks, _ = trained(spark, x, y, trees=2, depth=2)
    assert all(abs(t.stats[0].sum() - 700) < 140 for t in blocks)


def test_cut_points_lie_between_values():
    assert forest.cut_points(np.array([1.0, 2.0, 4.0]), np.ones(3)).tolist() == [1.5, 3.0]
    assert forest.cut_points(np.array([1.0]), np.ones(1)).tolist() == []
    many = forest.cut_points(np.arange(1000.0), np.ones(1000))
    assert len(many) == 31 and np.abs(np.diff(many) - 31.25).max() <= 1
    heavy = forest.cut_points(np.arange(1000.0), np.where(np.arange(1000) == 500, 1e6, 1.0))
    assert 500.5 in heavy or 499.5 in heavy


def test_a_frequent_row_has_its_bin_in_a_sample(spark, monkeypatch):
    """A row of many copies is in the sample with its part, however small the sample."""
    monkeypatch.setattr(forest, "SAMPLE", 1000)
    many = spark.range(20000).select(F.when(q("id") % 3 > 0, q("id") % 997).cast("double").alias("a"))
    for value in (500.25, 300.25, 700.25):
        digest = spark.range(1).select(F.xxhash64(F.lit(value))).first()[0]
        cuts, = forest._cuts(many.fillna(value), ["a"], 20000, [digest])
        for cut in (cuts[cuts < value].max(), cuts[cuts > value].min()):  # halfway to the next whole number of the sample
            assert (2 * cut - value).is_integer()
        assert len(cuts) > 10


def test_refuses_tables_without_two_labels(spark):
    x, y = drawn(20)
    with pytest.raises(ValueError):
        trained(spark, x, y * 0)
    with pytest.raises(ValueError):
        models.train_forest(table_of(spark, x, y).withColumnRenamed("target", "label").limit(0), features=["a", "b"])
