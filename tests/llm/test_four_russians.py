"""Hard negatives against a plain search, and the scores of tables and planes against products of integers."""
import random
from collections import defaultdict

import numpy as np
import pytest

from sluice.llm import four_russians as russians
from sluice.llm.four_russians import bit_planes, hard_negatives, limits_of, scores, subset_sums, whole_numbers
from sluice.session import local_table


@pytest.mark.parametrize("width,most", [(1, 1), (7, 3), (8, 127), (9, 128), (64, 300), (65, 1 << 20), (5, 1 << 40), (3, 1 << 61), (4, 1 << 90)])
def test_scores_are_inner_products(monkeypatch, width, most):
    monkeypatch.setattr(russians, "STEP", 16)
    monkeypatch.setattr(russians, "TOGETHER", 3)
    rng = random.Random(width)
    a, c = ([[float(rng.randint(-most, most)) for _ in range(width)] for _ in range(n)] for n in (7, 40))
    c += [[0.0] * width, [-1.0] * width, [float(-most)] * width, [float(most)] * width]
    found = scores(whole_numbers(np.array(a)), bit_planes(whole_numbers(np.array(c))))
    clip = lambda x: max(-(1 << 63), min((1 << 63) - 1, x))
    assert found.tolist() == [[clip(sum(int(x) * int(y) for x, y in zip(p, q))) for q in c] for p in a]


def test_subset_sums():
    anchors = np.array([[1, 2, 4, 8, 16, 32, 64, 128, 5, -7]])
    table = subset_sums(anchors, 2, np.int64)
    assert table[0, :, 0].tolist() == list(range(256))
    assert [int(table[1, m, 0]) for m in range(8)] == [0, 5, -7, -2, 0, 5, -7, -2]


@pytest.mark.parametrize("score", [*range(-25, 26), 10 ** 17 + 7, -(10 ** 17) - 7])
def test_limits(score):
    x, y = limits_of(score, 30, 90)
    assert all((30 * score <= 100 * v <= 90 * score) == (x <= v <= y) for v in (x - 1, x, x + 1, y - 1, y, y + 1, 0))


def brute(rows, every=100, positives=5, negatives=10):
    known = set()
    for i, v, c in rows:
        if i is not None and v is not None and c is not None and all(x is not None and np.isfinite(x) for x in v):
            known.add((i, str(c), tuple(int(np.floor(256 * np.float64(x))) for x in v)))
    found = []
    for i, c, a in known:
        if i % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(a, b)), j, d) for j, d, b in known)
        for s, p, _ in [x for x in scored if x[1] != i and x[2] == c][:positives]:
            near = [(j, -t) for t, j, d in scored if d != c and -30 * s <= -100 * t <= -90 * s][:negatives]
            found += [(i, p, r, j, -s, t) for r, (j, t) in enumerate(near, 1)]
    return sorted(found)


def table(spark, rows):
    """With columns of names that the operator uses inside."""
    return local_table(spark, [(i, v, c, 1, "x") for i, v, c in rows], "vec_id long, embedding array<double>, label int, number int, part string")


def drawn(n, width=12, labels=4, seed=5):
    draw = np.random.default_rng(seed)
    middle = draw.normal(size=(labels, width))
    return [(i, [float(x) for x in 0.5 * middle[i % labels] + 0.7 * middle[0] + 0.4 * draw.normal(size=width)], i % labels) for i in range(n)]


@pytest.mark.parametrize("slice_rows,anchors,partitions", [(64, 2, 8), (32768, 1024, 8), (50, 3, 1)])
def test_hard_negatives(spark, monkeypatch, slice_rows, anchors, partitions):
    monkeypatch.setattr(russians, "SLICE", slice_rows)
    monkeypatch.setattr(russians, "LEAST", slice_rows)
    monkeypatch.setattr(russians, "ANCHORS", anchors)
    rows = drawn(500)
    rows += [(1000 + i, rows[7][1], i % 4) for i in range(150)]  # copies, some of them anchors
    rows += [rows[3], rows[100], rows[100], (100, rows[9][1], 1), (200, rows[200][1], 3)]
    rows += [(2000, None, 1), (2100, [1.0, None], 1), (2200, [float("nan")], 1), (2300, [float("inf"), 1.0], 1), (None, [1.0], 1), (2400, [1.0], None),
             (2500, [], 1), (2600, [0.0] * 12, 2), (2700, [2.0, -1.0], 0), (-300, rows[0][1], 0), (2800, [-x for x in rows[0][1]], 0)]
    got = sorted(tuple(r) for r in hard_negatives(table(spark, rows).repartition(partitions)).collect())
    assert got == brute(rows) and len(got) > 200


def test_edges(spark):
    assert hard_negatives(table(spark, drawn(500)).limit(0)).count() == 0
    alone = [(100, [1.0], 1), (200, [1.0], 2)]
    assert hard_negatives(table(spark, alone)).count() == 0
    few = [(0, [4.0], 1), (1, [3.0], 1), (2, [2.0], 2), (3, [1.0], 3), (4, [-1.0], 1)]
    got = sorted(tuple(r) for r in hard_negatives(table(spark, few)).collect())
    assert got == brute(few) and {r[1] for r in got} == {1}
    huge = [(0, [1e30], 1), (1, [2e30], 1), (2, [0.5], 2), (3, [1e300], 2), (4, [5e-15], 2), (5, [1e308], 2), (6, [1.0], 1)]
    got = hard_negatives(table(spark, huge)).collect()
    assert {(r["positive_id"], r["positive_score"]) for r in got} <= {(1, (1 << 63) - 1), (6, (1 << 63) - 1)}


def test_many_labels(spark):
    rows = [(i, v, i // 3) for i, v, _ in drawn(600)]
    assert sorted(tuple(r) for r in hard_negatives(table(spark, rows), every=50).collect()) == brute(rows, every=50)


def test_anchor_has_no_more_than_asked(spark):
    got = hard_negatives(table(spark, drawn(400)), every=100).collect()
    per = defaultdict(list)
    for r in got:
        per[r["anchor_id"], r["positive_id"]].append(r)
    assert all([r["rank"] for r in sorted(rs, key=lambda r: r["rank"])] == list(range(1, len(rs) + 1)) and len(rs) <= 10 for rs in per.values())
