"""Search, mixing, sharding and training order against brute force."""
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from edge import documents, empty, texts
from sluice.llm import norm_buckets, training_order as order
from sluice.llm.mixing import mixed, mixing_plan, word_count
from sluice.llm.sharding import balanced_shards
from sluice.session import local_table


def brute_top(rows, k, every):
    known = {(i, tuple(int(np.floor(64 * np.float64(x))) for x in v)) for i, v in rows
             if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    for q, a in known:
        if q % every == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in known if i != q)
            for rank, (s, i) in enumerate(scored[:k], 1):
                yield q, rank, i, -s


def vectors(spark, rows):
    return local_table(spark, rows, "vec_id long, embedding array<double>, rank int, score string")


@pytest.mark.parametrize("block,spread", [(16, 1.0), (2048, 1.0), (16, 0.02)])
def test_top_k(spark, monkeypatch, block, spread):
    monkeypatch.setattr(norm_buckets, "BLOCK", block)
    monkeypatch.setattr(norm_buckets, "HEAD", 32)
    draw = np.random.default_rng(3)
    middle = draw.normal(size=8)
    rows = [(i, (middle + spread * draw.normal(size=8)) * np.exp(draw.normal())) for i in range(300)]
    rows = [(i, [float(x) for x in v], 1, None) for i, v in rows]
    rows += [(1000 + i, rows[7][1], 1, None) for i in range(60)] + [rows[3], rows[3]]
    rows += [(20_000, None, 1, None), (20_020, [1.0, None], 1, None), (20_040, [float("nan")], 1, None), (20_060, [float("inf"), 1.0], 1, None), (None, [1.0], 1, None),
             (20_080, [], 1, None), (20_100, [0.0] * 8, 1, None), (20_120, [2.0, -1.0], 1, None), (-40, rows[0][1], 1, None)]
    found = norm_buckets.top_k(vectors(spark, rows), k=5, every=20)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    assert Counter(tuple(r) for r in found.collect()) == Counter(brute_top([r[:2] for r in rows], 5, 20))


def test_top_k_of_few_and_huge(spark):
    rows = [(0, [1e7, 2.0], 1, None), (20, [1e7, -2.0], 1, None), (3, [-3e7, 7.0], 1, None)]
    found = norm_buckets.top_k(vectors(spark, rows), k=5, every=20)
    assert Counter(tuple(r) for r in found.collect()) == Counter(brute_top([r[:2] for r in rows], 5, 20))
    assert norm_buckets.top_k(vectors(spark, rows).limit(0)).count() == 0
    clamped = norm_buckets.top_k(vectors(spark, [(0, [1e300], 1, None), (1, [1e300], 1, None)]))
    assert [tuple(r) for r in clamped.collect()] == [(0, 1, 1, (1 << 63) - 1)]


def test_mixing(spark):
    rows = [(i, "w " * (1 + i * 7 % 13), "en", s, 0, None, 0, None) for i, s in enumerate(["a"] * 400 + ["b"] * 60 + [None] * 30 + ["é"] * 200 + ["c"] * 3)]
    docs = local_table(spark, rows + [(9999, None, None, "a", None, None, None, None)], documents(spark).schema)
    plan = mixing_plan(docs).collect()
    assert len(plan) == len(rows) + 1
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for r in plan:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert r.taken == r.size * r.epochs and 0 <= r.epochs <= 3
    weight = {s: k % 3 + 1 for k, s in enumerate(sorted(x for x in sizes if x) + [None])}
    budget = sum(sizes.values())
    assert abs(sum(target.values()) - budget) < 1e-6 * budget
    free = [s for s in sizes if target[s] < 3 * sizes[s] - 1e-9]
    assert len({round(target[s] / weight[s], 6) for s in free}) == 1
    assert all(target[s] / weight[s] <= target[free[0]] / weight[free[0]] + 1e-6 for s in sizes)
    assert all(abs(taken[s] - target[s]) <= 13 for s in sizes) and sum(taken.values()) <= budget
    assert sorted(map(tuple, plan), key=str) == sorted(map(tuple, mixing_plan(docs.repartition(5)).collect()), key=str)
    got = mixed(docs)
    assert got.columns == docs.columns
    assert Counter(r.doc_id for r in got.collect()) == Counter({r.id: r.epochs for r in plan if r.epochs})


def test_mixing_takes_awkward_rows(spark):
    plan = mixing_plan(documents(spark))
    assert plan.count() == documents(spark).count()
    total = plan.selectExpr("sum(taken) <= sum(size)", "min(epochs)", "max(epochs)").first()
    assert total[0] and 0 <= total[1] and total[2] <= 3
    assert mixed(documents(spark)).where("doc_id is null or doc_id >= 0").count() > 0
    assert mixing_plan(empty(spark)).count() == 0 and mixed(empty(spark)).count() == 0
    counts = documents(spark).select("text", word_count("text")).collect()
    assert all(n == len((t or "").split(None)) for t, n in counts if t is None or t.isascii())


@pytest.mark.parametrize("copies", [0, 150])
def test_sharding(spark, copies):
    values = texts(n=90)[:-1] + [f"alone {i} " * (1 + i % 9) for i in range(300)] + ["the same text again and again"] * copies
    docs = documents(spark, values)
    rows = balanced_shards(docs, shards=8).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == Counter(
        (d, len((t or "").encode()) + 1, None if t is None else zlib.crc32(t.encode())) for d, t in docs.select("doc_id", "text").collect())
    loads, slots, where = Counter(), defaultdict(list), defaultdict(Counter)
    for r in rows:
        loads[r.shard] += r.size
        slots[r.shard].append(r.slot)
        where[(r.text_crc32, r.size) if r.text_crc32 is not None else r.slot + r.shard / 100][r.shard] += 1
        assert r.law == "bytes" and r.grown_shard is None
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(loads) == set(range(8))
    assert max(loads.values()) - min(loads.values()) <= 1200
    together = [sum(c.values()) == max(c.values()) for c in where.values() if sum(c.values()) > 1]
    assert sum(together) >= 0.9 * len(together)
    columns = ["doc_id", "size", "text_crc32", "shard", "slot"]
    again = balanced_shards(docs.repartition(7), shards=8).select(columns)
    assert Counter(map(tuple, again.collect())) == Counter(tuple(r[c] for c in columns) for r in rows)


def test_sharding_of_nothing(spark):
    assert balanced_shards(empty(spark)).count() == 0
    assert balanced_shards(documents(spark, ["only one"]).limit(1), shards=4).count() == 1


@pytest.mark.parametrize("size", [1, 2, 3, 1000, 65_537])
def test_permutation(size):
    places = order.permuted(np.arange(size), size, 5)
    assert sorted(places.tolist()) == list(range(size))
    if size > 100:
        assert (places != order.permuted(np.arange(size), size, 6)).mean() > 0.9 and abs(np.corrcoef(places.astype(float), np.arange(size))[0, 1]) < 0.2


def test_training_order_round_trip(spark, tmp_path):
    docs = documents(spark, [t for t in texts() if t is None or len(t) < 5000])
    index = order.write_shards(docs, str(tmp_path), length=16, places_per_shard=64, written_first=True).orderBy("slot").collect()
    assert [r.slot for r in index] == list(range(len(index)))
    encode, stride = order.encoder(order.RANKS), 32
    files = sorted(tmp_path.glob("shard-*.bin"))
    stream = b"".join(f.read_bytes() for f in files)
    assert len(stream) == len(index) * stride and len(files) > 3
    begins = {}
    for r in index:
        record = stream[r.slot * stride:(r.slot + 1) * stride]
        begins.setdefault(r.shard, r.slot)
        assert zlib.crc32(record) == r.crc32 and r.byte_offset == (r.slot - begins[r.shard]) * stride
    # Put the sequences of each task back in their order and cut the stream at end tokens.
    tokens = Counter()
    for r in index:
        record = np.frombuffer(stream[r.slot * stride:(r.slot + 1) * stride], "<u2")[:r.n_tokens]
        tokens.update(record.tolist())
    want = Counter()
    for (text,) in docs.select("text").collect():
        if text:
            want.update(encode(text).tolist())
    assert tokens == want and sum(r.n_docs for r in index) == want[encode.end]


def test_training_order_decodes(spark, tmp_path):
    values = [t for t in texts() if t and len(t) < 3000]
    docs = documents(spark, values).coalesce(1)
    index = order.write_shards(docs, str(tmp_path), length=64, places_per_shard=16, written_first=True)
    size = index.count()
    assert size > 40
    stream = b"".join(f.read_bytes() for f in sorted(tmp_path.glob("shard-*.bin")))
    records = [np.frombuffer(stream[i * 128:(i + 1) * 128], "<u2") for i in range(size)]
    # One task: sequence i stands at the rank of its place among the places in use.
    total = sum(len(t.encode()) + 1 for (t,) in docs.select("text").collect() if t)
    places = order.permuted(np.arange(size), -(-total // 64), 1)
    joined = np.concatenate([records[k] for k in np.argsort(np.argsort(places))])
    encode = order.encoder(order.RANKS)
    parts = np.split(joined, np.flatnonzero(joined == encode.end) + 1)
    decoded = [encode.encoding.decode(p[:-1].tolist()) for p in parts if len(p) > 1]
    assert sorted(decoded) == sorted(t for (t,) in docs.select("text").collect() if t)


def test_training_order_of_nothing(spark, tmp_path):
    assert order.write_shards(empty(spark), str(tmp_path)).count() == 0


def test_long_runs_are_encoded_like_short_ones(monkeypatch):
    """Cutting out runs of white space changes no token, and a million of any sign can be encoded."""
    import random
    import re
    rng, encode = random.Random(1), order.encoder(order.RANKS)
    monkeypatch.setattr(order, "LONG_SPACE", re.compile(order.LONG_SPACE.pattern.replace("{1000,}", "{2,}")))
    for _ in range(500):
        text = "".join(rng.choice([" ", "  ", "\n", "\t", " \n", "a", "bc", "é", "!", "'s", "1", "\u3000", "\x1c", " x"]) for _ in range(rng.randrange(30)))
        assert encode(text).tolist() == encode.encoding.encode_ordinary(text) + [encode.end]
    monkeypatch.undo()
    for sign in " a?\n\xa0é":
        assert encode.encoding.decode(encode(sign * 1_000_000 + "x")[:-1].tolist()) == sign * 1_000_000 + "x"


def test_tables_that_change_between_readings_are_refused(spark):
    with pytest.raises(Exception, match="dealt out anew"):
        order._sequences(documents(spark, ["some words of text"] * 5).select(order.F.col("doc_id").alias("id"), "text"), {}, 10, 8, 1, order.RANKS).collect()
