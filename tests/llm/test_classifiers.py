"""Held-out accuracy of the classifiers, segment search against brute force, and awkward rows."""
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from edge import documents, empty
from sluice.llm import byte_cnn, toxic_segments as toxic
from sluice.llm.folds import held_out, labelled_sample
from sluice.session import local_table

SF = "/root/testdata/sf0.1"


def tables(spark, sf=SF):
    return spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")


def test_fold_is_the_crc_of_the_id(spark):
    ids = local_table(spark, [(i,) for i in range(200)] + [(None,)], "doc_id long")
    got = dict(ids.select("doc_id", held_out("doc_id")).collect())
    assert got.pop(None) is True and got == {i: zlib.crc32(str(i).encode()) % 5 == 0 for i in range(200)}
    docs, labels = tables(spark, "/root/testdata/sf0.01")
    assert labelled_sample(docs, labels, "quality", "doc_id", "text", 50).count() == 50


def test_quality_on_held_out(spark, monkeypatch):
    docs, labels = tables(spark)
    monkeypatch.setattr(byte_cnn, "FIT_TEXTS", 6000)
    found = byte_cnn.quality(docs, labels, fit_rows=1200).join(labels, "doc_id").where("held_out").select("score", "predicted", "quality").toPandas()
    assert len(found) > 500 and (found.predicted == found.quality).mean() > 0.97
    assert found.score.between(0, 1).all() and found[found.quality == 1].score.median() > found[found.quality == 0].score.quantile(0.9)


def test_a_row_scores_alone_as_in_company():
    draw = random.Random(2)
    texts = [bytes(draw.choice(b"abc DEF!!\n") for _ in range(n)) for n in (0, 1, 31, 32, 64, 700, 5000, 300_000)]
    network = byte_cnn.Network()
    data = np.frombuffer(b"".join(texts), np.uint8)
    together = network.scores(data, np.concatenate([[0], np.cumsum([len(t) for t in texts])]))
    alone = [network.scores(np.frombuffer(t, np.uint8), np.array([0, len(t)]))[0] for t in texts]
    assert np.allclose(together, alone, atol=1e-5)


def test_gradients_are_those_of_the_loss():
    network, text = byte_cnn.Network(), b"Some text, SOME!! text text text text " * 40
    network.p = {k: v.astype(np.float64) for k, v in network.p.items()}

    def loss():
        return -np.log(network.scores(np.frombuffer(text, np.uint8), np.array([0, len(text)]))[0])

    grads, draw = network._gradients(text, 1), np.random.default_rng(1)
    for name in ("w", "v", "u", "b", "wb", "vb"):
        flat, g = network.p[name].reshape(-1), grads[name].reshape(-1)
        for i in draw.choice(len(flat), min(4, len(flat)), replace=False):
            kept = flat[i]
            flat[i] = kept + 1e-3
            up = loss()
            flat[i] = kept - 1e-3
            down = loss()
            flat[i] = kept
            assert abs((up - down) / 2e-3 - g[i]) < 2e-2 * max(1, abs(g[i]))


def test_quality_of_awkward_rows(spark):
    labels = local_table(spark, [(37, 1, 0), (74, 0, 1), (111, None, None), (None, 1, 1), (37, 0, 1)], "doc_id long, quality int, toxic int")
    for table in (labels, labels.limit(0)):
        got = byte_cnn.quality(documents(spark), table)
        assert got.columns == ["doc_id", "held_out", "score", "predicted"]
        rows = got.collect()
        assert len(rows) == documents(spark).count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    assert byte_cnn.good_documents(documents(spark), labels.limit(0)).count() == documents(spark).count()
    assert byte_cnn.good_documents(documents(spark), labels).columns == documents(spark).columns
    assert byte_cnn.quality(empty(spark), labels).count() == 0


def brute_segments(values):
    """Ruzzo and Tompa's definition: the leftmost best run, then the same to its left and right, while the score is positive."""
    if not values or max(values) <= 0:
        return []
    sums = np.concatenate([[0], np.cumsum(values)])
    score, size, a, b = max((round(sums[j] - sums[i], 9), -(j - i), i, j) for i in range(len(values)) for j in range(i + 1, len(values) + 1))
    left, right = brute_segments(values[:a]), brute_segments(values[b:])
    return left + [(a, b - 1, score)] + [(x + b, y + b, s) for x, y, s in right]


def test_all_maximal_segments():
    draw = np.random.default_rng(4)
    for _ in range(200):
        at = np.flatnonzero(draw.random(30) < 0.3)
        scores = draw.uniform(0.5, 4, len(at))
        model = toxic.Model(other=-0.7)
        values = np.full(30, model.other)
        values[at] = scores
        got = [(int(a), int(b), round(s, 6)) for a, b, s in model.segments(at, scores)]
        assert got == [(a, b, round(float(s), 6)) for a, b, s in brute_segments(values.tolist())]


def test_segments_in_linear_time():
    """A million words with terms, each a segment of its own, or all parts of a few."""
    import time
    model, began = toxic.Model(other=-0.7), time.time()
    at = np.arange(1_000_000) * 10
    assert len(model.segments(at, np.full(len(at), 2.0))) == len(at)
    assert len(model.segments(at, np.random.default_rng(0).uniform(0, 14, len(at)))) < 1000
    assert time.time() - began < 60


def test_toxicity_on_held_out(spark):
    docs, labels = tables(spark)
    found = toxic.toxicity(docs, labels)
    judged = found.join(labels, "doc_id").where("held_out").select("score", "predicted", "toxic", "quality").toPandas()
    assert (judged.predicted == judged.toxic).mean() > 0.98 and judged[judged.toxic == 1].predicted.mean() > 0.9
    row = found.join(docs, "doc_id").where("size(passages) > 0").select("text", F.explode("passages").alias("p")).first()
    passage = row.text.encode()[row.p["first"]:row.p["behind"]]
    assert passage and b" " not in (passage[:1], passage[-1:])


def test_toxicity_of_awkward_rows(spark):
    labels = local_table(spark, [(37, 1, 0), (74, 0, 1), (111, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    for table in (labels, labels.limit(0)):
        rows = toxic.toxicity(documents(spark), table).collect()
        assert len(rows) == documents(spark).count() and all(0 <= r.score <= 1 for r in rows)
    assert toxic.toxicity(empty(spark), labels).count() == 0
