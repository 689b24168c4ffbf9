"""The distributed booster against one that sums over rows, and contributions of its trees against the definition."""
from itertools import combinations
from math import factorial

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluice.functions import q
from sluice.operators import boosting, explain, models
from sluice.session import local_table, scratch_path


def drawn(n=700, seed=2):
    draw = np.random.default_rng(seed)
    x = np.stack([draw.integers(0, 12, n).astype(float), draw.normal(size=n).round(1), draw.integers(0, 3, n).astype(float), np.ones(n), draw.uniform(size=n).round(2)], axis=1)
    x[draw.random(n) < 0.1, 1] = np.nan
    y = np.where(x[:, 0] > 7, 2, np.where((x[:, 2] == 1) | np.isnan(x[:, 1]), 1, 0))
    y[draw.random(n) < 0.05] = 0
    return x, y


def plain_booster(x, y, n_labels, rounds, depth, step=0.3, penalty=1.0, least_cover=1.0):
    """Splits found by summing the rows on either side of every candidate."""
    scale = float(1 << 30)
    cuts = [np.unique(c[~np.isnan(c)])[:-1] for c in x.T]
    scores, model = np.zeros((len(x), n_labels)), []
    for _ in range(rounds):
        g, h = boosting.derivatives(scores, y, scale)
        trees, moves = [], np.zeros_like(scores)
        for k in range(n_labels):
            nodes, level = [], [(0, np.arange(len(x)))]
            nodes.append(None)
            score = lambda rows: (g[rows, k].sum() / scale) ** 2 / (h[rows, k].sum() / scale + penalty)
            for d in range(depth + 1):
                below = []
                for at, rows in level:
                    best = (1e-6, None)
                    for f in range(x.shape[1]) if d < depth else ():
                        v = x[rows, f]
                        for cut in [*cuts[f], np.inf]:
                            for missing_left in (True, False) if cut < np.inf else (False,):
                                goes = np.where(np.isnan(v), missing_left, v <= cut)
                                left, right = rows[goes], rows[~goes]
                                if min(h[left, k].sum(), h[right, k].sum()) < least_cover * scale:
                                    continue
                                gain = score(left) + score(right) - score(rows)
                                if gain > best[0]:
                                    best = (gain, (f, cut, missing_left, left, right))
                    value = -(g[rows, k].sum() / scale) / (h[rows, k].sum() / scale + penalty) * step
                    if best[1] is None:
                        nodes[at] = (-1, 0.0, True, -1, -1, value)
                        moves[rows, k] = value
                        continue
                    f, cut, missing_left, left, right = best[1]
                    nodes[at] = (f, float(cut), missing_left, len(nodes), len(nodes) + 1, value)
                    below += [(len(nodes), left), (len(nodes) + 1, right)]
                    nodes += [None, None]
                level = below
            trees.append(nodes)
        scores += moves
        model.append(trees)
    return model


def table_of(spark, x, y):
    rows = [([None if np.isnan(v) else float(v) for v in r], int(t)) for r, t in zip(x, y)]
    return local_table(spark, rows, "values array<double>, target int")


def nodes_of(model):
    return [[[(int(f), float(t), bool(m), int(b), int(a), float(v)) for f, t, m, b, a, v in zip(tree.feature, tree.threshold, tree.missing_left, tree.below, tree.above, tree.value)]
             for tree in trees] for trees in model.trees]


def test_same_trees_as_a_plain_booster(spark):
    x, y = drawn()
    got = nodes_of(boosting.train(table_of(spark, x, y), 3, x.shape[1], rounds=3, depth=3))
    want = plain_booster(x, y, 3, 3, 3)
    for trees, plain in zip(got, want):
        for tree, nodes in zip(trees, plain):
            assert [n[:5] for n in tree] == [(f, t, m if f >= 0 else True, b, a) for f, t, m, b, a, _ in nodes]
            assert np.allclose([n[5] for n in tree], [n[5] for n in nodes], rtol=1e-12)


@pytest.mark.parametrize("bytes_", [boosting.HISTOGRAM_BYTES, 9000])
def test_the_same_model_for_any_partitioning(spark, monkeypatch, bytes_):
    """Also with histograms of a few features per pass, over a tree of sums, and with checkpoints."""
    x, y = drawn(2500, 5)
    df = table_of(spark, x, y)
    first = nodes_of(boosting.train(df.repartition(4), 3, x.shape[1], rounds=5, depth=4))
    monkeypatch.setattr(boosting, "HISTOGRAM_BYTES", bytes_)
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 40)
    monkeypatch.setattr(boosting, "DIRECT", 2)
    monkeypatch.setattr(boosting, "CHECKPOINT_EVERY", 2)
    spark.sparkContext.setCheckpointDir(scratch_path(spark, "checkpoints"))
    assert nodes_of(boosting.train(df.repartition(16), 3, x.shape[1], rounds=5, depth=4)) == first


def test_scores_follow_the_trees(spark):
    x, y = drawn()
    model = boosting.train(table_of(spark, x, y), 3, x.shape[1], rounds=4, depth=3)
    x = np.vstack([x, [[np.nan] * 5, [np.inf] * 5, [-np.inf] * 5]])
    want = np.zeros((len(x), 3))
    for trees in nodes_of(model):
        for k, nodes in enumerate(trees):
            for i, row in enumerate(x):
                at = 0
                while nodes[at][0] >= 0:
                    f, t, m, b, a, _ = nodes[at]
                    at = b if (m if np.isnan(row[f]) else row[f] <= t) else a
                want[i, k] += nodes[at][5]
    assert np.array_equal(model.scores(x), want)
    assert (model.scores(x[:700]).argmax(axis=1) == y).mean() > 0.9
    again = boosting.Boosted.of_table(model.table(spark), 3)
    assert np.array_equal(again.scores(x), want) and abs(model.importance(5).sum() - 1) < 1e-12 and model.importance(5)[3] == 0


def test_many_values_and_hot_values(spark):
    """Bins of about equal counts; a value that fills half of the rows is a bin of its own."""
    values, counts = np.arange(10_000.0), np.ones(10_000, int)
    counts[5000] = 10_000
    cuts = boosting.cut_points(values, counts)
    assert len(cuts) < boosting.BINS - 1 and 5000.0 in cuts and 4999.0 >= cuts[np.searchsorted(cuts, 5000.0) - 1] > 4800
    draw = np.random.default_rng(0)
    x = draw.normal(size=(3000, 2))
    model = boosting.train(table_of(spark, x, (x[:, 0] > 0.3).astype(int)), 2, 2, rounds=10, depth=3)
    assert (model.scores(x).argmax(axis=1) == (x[:, 0] > 0.3)).mean() > 0.995


def test_empty_and_single_label(spark):
    x, y = drawn(20)
    assert boosting.train(table_of(spark, x, y).limit(0), 0, 5).trees == []
    assert boosting.train(table_of(spark, x, y * 0), 1, 5).scores(x).tolist() == [[0.0]] * 20


@pytest.fixture(scope="module")
def flows(spark):
    x, y = drawn(900, 9)
    rows = [(i, *[None if np.isnan(v) else float(v) for v in r], ["tcp", "udp", None][int(r[2])], ["BENIGN", "Bot", "DoS"][t]) for i, (r, t) in enumerate(zip(x, y))]
    return local_table(spark, rows, "id bigint, a double, b double, c double, d double, e double, proto string, label string")


FEATURES = ["a", "b", "d", "e", "proto"]


@pytest.fixture(scope="module")
def boosted(flows):
    return models.train_boosted(flows, features=FEATURES, rounds=6, depth=4)


def test_boosted_saved_and_scored(spark, flows, boosted):
    scored = models.score_batch(boosted, flows)
    assert scored.columns == [*flows.columns, "predicted_label"] and scored.where("label <> predicted_label").count() < 90
    loaded = models.load_model(models.save_model(boosted, scratch_path(spark, "model")))
    assert models.score_batch(loaded, flows).exceptAll(scored).count() == 0
    assert models.score_batch(loaded, flows.drop("d", "label").withColumn("proto", F.lit("sctp"))).count() == 900
    importance = {r[0]: r[1] for r in models.feature_importance(loaded).collect()}
    assert abs(sum(importance.values()) - 100) < 1e-9 and importance["d"] == 0


def test_boosted_contributions_add_up(flows, boosted):
    rows = {r["id"]: r for r in explain.explain_rows(boosted, flows, "id", all_rows=True).collect()}
    scored = models._assembled(boosted, flows).select(q("_carry0").alias("id"), "_raw", "_prediction").collect()
    assert len(rows) == 900
    for r in scored:
        assert abs(rows[r["id"]]["base"] + sum(rows[r["id"]]["contributions"]) - r["_raw"][int(r["_prediction"])]) < 1e-9
    said = explain.explain_predictions(boosted, flows, "id").collect()
    assert len(said) == 3 and all(r["explanation"].count(" was ") == 3 for r in said)


def test_boosted_contributions_equal_the_definition(spark):
    """Shapley values over all subsets of features: unknown features go both ways by the cover of the children."""
    x, y = drawn(300, 4)
    model = boosting.train(table_of(spark, x, y), 3, x.shape[1], rounds=2, depth=3)
    rows, classes = x[:12], np.arange(12) % 3

    def value(tree, row, known, at=0):
        if tree.feature[at] < 0:
            return tree.value[at]
        f, below, above = tree.feature[at], tree.below[at], tree.above[at]
        if f in known:
            left = tree.missing_left[at] if np.isnan(row[f]) else row[f] <= tree.threshold[at]
            return value(tree, row, known, below if left else above)
        return (tree.cover[below] * value(tree, row, known, below) + tree.cover[above] * value(tree, row, known, above)) / tree.cover[at]

    got, base = explain.contributions(explain.boosted_leaves(model), rows, classes, scale=1.0)
    for i, row in enumerate(rows):
        total = lambda known: sum(value(trees[classes[i]], row, known) for trees in model.trees)
        assert abs(base[i] - total(())) < 1e-9
        for f in range(5):
            others = [o for o in range(5) if o != f]
            want = sum(factorial(len(s)) * factorial(4 - len(s)) / factorial(5) * (total({*s, f}) - total(s)) for n in range(5) for s in combinations(others, n))
            assert abs(got[i, f] - want) < 1e-9


@pytest.mark.parametrize("train,options", [(models.train_forest, {"trees": 3, "depth": 3}), (models.train_boosted, {"rounds": 2, "depth": 2})])
def test_text_features_with_more_values_than_are_held(spark, monkeypatch, train, options):
    monkeypatch.setattr(models, "MAX_CATEGORIES", 10)
    df = spark.range(2000).select("id", F.concat(F.lit("host-"), F.lpad(q("id").cast("string"), 6, "0")).alias("host"), (q("id") % 7).cast("double").alias("x"),
                                  F.when(q("id") < 1200, "A").otherwise("B").alias("label"))
    model = train(df, features=["host", "x"], **options)
    assert model.codes["host"][1] == 2000
    scored = models.score_batch(model, df)
    assert scored.where("label <> predicted_label").count() < 40
    loaded = models.load_model(models.save_model(model, scratch_path(spark, "wide")))
    assert models.score_batch(loaded, df).exceptAll(scored).count() == 0
    assert models.score_batch(loaded, df.withColumn("host", F.lit("unknown"))).count() == 2000


def test_equal_rows_are_one_row_with_a_count(spark, monkeypatch):
    """The passes see each (bins, label) once, and the model is that of all rows."""
    x, y = drawn(400, 5)
    x = np.round(x)
    many = table_of(spark, np.tile(x, (6, 1)), np.tile(y, 6))
    sizes, written = [], boosting.written
    monkeypatch.setattr(boosting, "written", lambda df, name: (sizes.append((name, df.count())), written(df, name))[1])
    model = boosting.train(many, 3, x.shape[1], rounds=2, depth=3)
    assert dict(sizes)["training"] == 2400 and dict(sizes)["counted"] <= 400
    assert sum(model.trees[0][0].cover[model.trees[0][0].feature < 0]) > 2400 * 0.3


def test_sums_beyond_doubles():
    index, weights = np.array([0, 1, 0, 0, 1]), np.array([(1 << 58) + 1, -(1 << 57) - 3, 5, 1 << 54, 7])
    assert boosting._exact_sums(index, weights, 2, False).tolist() == [(1 << 58) + (1 << 54) + 6, -(1 << 57) + 4]
    assert boosting._exact_sums(index, weights % 1000, 2, True).tolist() == boosting._exact_sums(index, weights % 1000, 2, False).tolist()
