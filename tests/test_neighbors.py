import numpy as np
import pytest
from pyspark.sql import functions as F

from sluice.functions import q
from sluice.operators import balance, neighbors
from sluice.session import local_table


def points(spark, n=240, copies=80, seed=0):
    """Clustered points on a coarse grid (many ties), a third of them copies of one point."""
    rng = np.random.default_rng(seed)
    xy = np.round(rng.normal(size=(n, 3)) + 6 * rng.integers(0, 3, size=(n, 1)), 1)
    xy[:copies] = xy[0]
    labels = ["ab"[i] for i in rng.integers(0, 2, size=n)]
    order = rng.permutation(n)
    return local_table(spark, [(int(k), *map(float, xy[i]), labels[i]) for k, i in enumerate(order)], "id bigint, x double, y double, z double, label string")


def brute(df, k, within):
    rows = df.collect()
    out = set()
    for a in rows:
        near = sorted((float(np.sqrt(sum((a[c] - b[c]) ** 2 for c in "xyz"))), b["id"]) for b in rows
                      if b["id"] != a["id"] and (not within or b["label"] == a["label"]))
        out |= {(a["id"], r + 1, key, round(d, 9)) for r, (d, key) in enumerate(near[:k])}
    return out


@pytest.mark.parametrize("within", [None, "label"])
@pytest.mark.parametrize("block_rows,pivots", [(2048, None), (16, 12)])
def test_neighbours_equal_brute_force(spark, within, block_rows, pivots, monkeypatch):
    monkeypatch.setattr(neighbors, "COPY_BLOCK", 20)
    df = points(spark)
    got = neighbors.knn_join(df, df, "id", ["x", "y", "z"], 4, within, block_rows=block_rows, pivots=pivots)
    assert {(r["id"], r["rank"], r["neighbor"], round(r["distance"], 9)) for r in got.collect()} == brute(df, 4, within)


def test_few_neighbours(spark):
    df = local_table(spark, [(1, 0.0, "a"), (2, 1.0, "a"), (3, 5.0, "b")], "id bigint, x double, label string")
    got = neighbors.knn_lists(df, df, "id", ["x"], 5, "label")
    assert {r["id"]: [n["key"] for n in r["neighbors"]] for r in got.collect()} == {1: [2], 2: [1], 3: []}


@pytest.mark.parametrize("fanout,block_rows", [(4, 20), (64, 16)])
def test_trees_of_several_levels(spark, monkeypatch, fanout, block_rows):
    """Cells are split until they are small, also where one is far larger than the others, and nothing is lost."""
    monkeypatch.setattr(neighbors, "CHUNK_ROWS", 30)
    df = points(spark, 400, 100, 7)
    df = df.select("id", "label", *[F.round(q(c) * 10).alias(c) for c in "xyz"])  # whole numbers, for exact ties
    base = neighbors._distinct_base(df.select(q("id").alias("_k"), q("label").alias("_l"), F.lit("").alias("_g"), neighbors.vector_of(df, ["x", "y", "z"]).alias("_v")), 4)
    placed, levels = neighbors._tree(base, base.schema["_ks"].dataType.elementType, block_rows, fanout)
    sizes = {r["_cell"]: r["count"] for r in placed.groupBy("_cell").count().collect()}
    assert max(sizes.values()) <= block_rows and sum(sizes.values()) == base.count() and len(levels) >= (2 if fanout < 64 else 1)
    got = neighbors.knn_join(df, df, "id", ["x", "y", "z"], 4, None, block_rows=block_rows, pivots=fanout)
    assert {(r["id"], r["rank"], r["neighbor"], round(r["distance"], 9)) for r in got.collect()} == brute(df, 4, None)


def test_queries_outside_the_base(spark):
    """Queries of other rows and of groups that the base does not have."""
    df = points(spark, 300, 10, 3)
    asked = df.where("id % 10 = 0").withColumn("label", F.when(q("id") % 20 == 0, "none").otherwise(q("label")))
    got = neighbors.knn_lists(asked, df.where("id % 10 <> 0"), "id", ["x", "y", "z"], 3, "label", block_rows=10, pivots=4).collect()
    assert len(got) == 30 and all(len(r["neighbors"]) == (0 if r["label"] == "none" else 3) for r in got)


def test_a_hundred_thousand_groups(spark):
    df = spark.range(300_000).select("id", F.floor(q("id") / 3).alias("label"), F.pmod(F.xxhash64("id"), F.lit(1000)).cast("double").alias("x"))
    got = neighbors.knn_lists(df, df, "id", ["x"], 2, "label")
    found = got.select(F.size("neighbors").alias("n"), F.forall("neighbors", lambda n: F.floor(n["key"] / 3) == q("label")).alias("same"))
    assert found.groupBy("n", "same").count().collect() == [(2, True, 300_000)]


@pytest.mark.parametrize("method", ["smote", "borderline", "adasyn"])
def test_oversampling_meets_targets(spark, method, monkeypatch):
    from sluice.operators import ranking
    monkeypatch.setattr(ranking, "COPY_BLOCK", 3)
    df = points(spark, 90, 20).withColumn("note", F.lit("n")).withColumn("label", F.when(q("id") < 15, "rare").otherwise(q("label")))
    targets = balance.balance_targets(df, 1.0)
    got = balance.oversample(df, targets, ["x", "y", "z"], method=method)
    most = max(r["n"] for r in targets.collect())
    assert {r["count"] for r in got.groupBy("label").count().collect()} == {most}
    assert got.where(~q("synthetic")).drop("synthetic").exceptAll(df).count() == 0
    again = balance.oversample(df.repartition(5), targets, ["x", "y", "z"], method=method)
    columns = ["label", *[F.round(c, 9) for c in "xyz"]]
    assert got.select(*columns).exceptAll(again.select(*columns)).count() == 0
    new = got.where("synthetic")
    assert new.where("id is not null or note is not null or x is null").count() == 0
    box = df.groupBy("label").agg(*[f(c).alias(f"{n}{c}") for c in "xyz" for f, n in ((F.min, "lo"), (F.max, "hi"))])
    outside = new.join(box, "label").where(" or ".join(f"{c} < lo{c} - 1e-9 or {c} > hi{c} + 1e-9" for c in "xyz"))
    assert outside.count() == 0


@pytest.mark.parametrize("method", ["smote", "adasyn"])
def test_oversampling_of_many_labels(spark, method, monkeypatch):
    """More labels than are broadcast, no label in the plan, and one label with a third of the rows."""
    monkeypatch.setattr(balance, "small_table", lambda df: (df, None))
    label = F.when(q("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), F.floor(q("id") / 12).cast("string")))
    df = spark.range(3600).select("id", label.alias("kind"), F.pmod(F.xxhash64("id"), F.lit(997)).cast("double").alias("x"))
    targets = balance.balance_targets(df, 0.01, "kind")
    got = balance.oversample(df, targets, ["x"], "kind", method=method)
    sizes = {r["kind"]: (r["n"], r["new"]) for r in got.groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.count_if("synthetic").alias("new")).collect()}
    assert len(sizes) == 301 and sizes.pop("hot") == (1200, 0) and set(sizes.values()) == {(12, 4)}
    assert "c17" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_targets_and_undersampling(spark):
    df = local_table(spark, [(i, "a" if i < 7 else "b" if i < 10 else None) for i in range(12)], "id int, label string")
    assert sorted(map(tuple, balance.balance_targets(df, 0.9).collect())) == [("a", 7, 7), ("b", 3, 6)]
    with pytest.raises(ValueError):
        balance.balance_targets(df, 1.5)
    aims = local_table(spark, [("a", 2)], "label string, target bigint")
    left = balance.undersample(df, aims, key="id").groupBy("label").count().collect()
    assert {r["label"]: r["count"] for r in left} == {"a": 2, "b": 3, None: 2}


def test_visits_carry_little(spark, monkeypatch):
    """Without structure every cell is visited: a visit gives one row, within the bound, and no vector."""
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(rng.normal(size=(300, 12)))]
    df = local_table(spark, rows, "id bigint, v array<float>")
    seen, visit = [], neighbors._visit

    def spied(visits, placed, *args):
        found = visit(visits, placed, *args)
        seen.append((visits.count(), found.columns, found.count(), found.agg(F.sum(F.size("_d"))).first()[0]))
        return found

    monkeypatch.setattr(neighbors, "_visit", spied)
    got = {r["id"]: [n["key"] for n in r["neighbors"]] for r in neighbors.knn_lists(df, df, "id", "v", 4, block_rows=20, vectors=False).collect()}
    xs = np.array([v for _, v in rows], np.float32).astype(float)
    apart = np.sqrt(((xs[:, None] - xs[None]) ** 2).sum(-1))
    assert got == {i: [j for j in np.lexsort((np.arange(300), apart[i])) if j != i][:4] for i in range(300)}
    visits, columns, n, entries = seen[1]
    assert columns == ["_id", "_d", "_n", "_nl", "_b"] and n <= visits and entries < 5 * visits / 2


def test_blocks_grow_with_their_group(spark):
    wide = spark.range(40_000).select(F.lit("").alias("_g"), F.array_repeat(F.lit(0.5), 64).alias("_v"))
    assert neighbors._block_rows(wide) == 16_384
    assert neighbors._block_rows(wide.withColumn("_v", F.array_repeat(F.lit(0.5), 3))) == 2500
    assert neighbors._block_rows(spark.range(640_000).select(F.lit("").alias("_g"), F.array_repeat(F.lit(0.5), 64).alias("_v"))) == 40_000
