"""Operators on texts against brute force, on a table with everything awkward."""
import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from edge import documents, empty, texts
from sluice.llm import block_anchors, decontaminate as dec, line_chunks, ngram_join
from sluice.llm.block_anchors import repeats_removed
from sluice.session import local_table


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def spaced(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


@pytest.mark.parametrize("group,cell", [(64, 256), (1, 4)])
def test_similar_components(spark, monkeypatch, group, cell):
    monkeypatch.setattr(ngram_join, "SMALL_GROUP", group)
    monkeypatch.setattr(ngram_join, "CELL", cell)
    rows = documents(spark).select("doc_id", "text").collect()
    sets = []
    for _, text in rows:
        w = spaced(low(text))
        sets.append({tuple(w[i:i + 3]) for i in range(max(1, len(w) - 2))} if w else set())
    part = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            k = len(sets[i] & sets[j])
            if k and 100 * k >= 70 * (len(sets[i]) + len(sets[j]) - k):
                part = [part[j] if p == part[i] else p for p in part]
    least = {p: min((rows[i][0] for i in range(len(rows)) if part[i] == p and rows[i][0] is not None), default=None) for p in set(part)}
    want = Counter((r[0], len(s), least[p]) for r, s, p in zip(rows, sets, part))
    got = ngram_join.similar_components(documents(spark), width=3, percent=70)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert Counter(tuple(r) for r in got.collect()) == want
    assert any(n > 3 for n in Counter(c for _, _, c in want.elements()).values())
    assert ngram_join.similar_components(empty(spark)).count() == 0


def entries(lists):
    """How often each hash is sent, by kind of bucket."""
    sent = {True: Counter(), False: Counter()}
    for r in lists.collect():
        sent[r.bucket < 0].update(ngram_join.unpack(bytes(r.hashes)).tolist())
    return sent[False], sent[True]


def test_copies_leave_a_piece_once(spark):
    docs = local_table(spark, [("one two three four five six",)] * 300, "text string").repartition(3)
    by_hash, by_node = entries(ngram_join._hash_lists(docs, "text", 4, True, 48))
    assert len(by_hash) == 3 and max(by_hash.values()) <= 3 and not by_node


def test_frequent_ngrams_are_dealt_by_node(spark, monkeypatch):
    passage = " ".join(f"w{i}" for i in range(30))
    docs = local_table(spark, [(i, f"{passage} a{i % 80} b{i % 80}") for i in range(240)], "doc_id long, text string").repartition(4)
    stats = ngram_join.shingle_stats(docs, "doc_id", "text", 4, True).cache()
    monkeypatch.setattr(ngram_join, "FREQUENT", 40)
    frequent, times = ngram_join.frequent_hashes(stats, 240 * 29)
    assert len(frequent) == 27 and (times >= 80).all()
    lists = ngram_join._hash_lists(docs, "text", 4, True, 48, frequent)
    by_hash, by_node = entries(lists)
    assert max(by_hash.values()) < 40 and set(by_node) == set(frequent.tolist())
    assert lists.where("bucket < 0").groupBy("bucket").count().count() > 20

    def shared(lists, of):
        rows = lists.groupBy("bucket").applyInArrow(of, "node long, hashes array<long>, counts array<int>").select("node", F.explode("hashes").alias("h"))
        return Counter(tuple(r) for r in rows.collect())

    none = np.zeros(0, np.uint64)
    want = shared(ngram_join._hash_lists(docs, "text", 4, True, 48), ngram_join._shared_of(none, none))
    assert len(want) == 80 * 27 and shared(lists, ngram_join._shared_of(frequent, times)) == want
    monkeypatch.setattr(ngram_join, "REPORTED", 1)
    monkeypatch.setattr(ngram_join, "FREQUENT", 2)
    rows = documents(spark).coalesce(1)
    assert len(ngram_join.frequent_hashes(ngram_join.shingle_stats(rows, "doc_id", "text", 3, True), 0)[0])
    found = Counter(tuple(r) for r in ngram_join.similar_components(rows, width=3, percent=70).collect())
    monkeypatch.setattr(ngram_join, "FREQUENT", 1 << 30)
    assert found == Counter(tuple(r) for r in ngram_join.similar_components(rows, width=3, percent=70).collect())


def test_block_anchors(spark):
    rows = documents(spark).select("doc_id", "text").collect()
    width, first = 7, {}
    for doc, text in rows:
        w = spaced(text)
        for i in range(len(w) - width + 1):
            if doc is not None:
                key = tuple(w[i:i + width])
                first[key] = min(first.get(key, doc), doc)
    want = Counter()
    for doc, text in rows:
        w = spaced(text)
        gone = {i + o for i in range(len(w) - width + 1) for o in range(width) if doc is not None and first[tuple(w[i:i + width])] < doc}
        want[(doc, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone))] += 1
    assert Counter(tuple(r) for r in repeats_removed(documents(spark), width=width).collect()) == want
    assert any(n for _, _, n, _ in want)
    digests = repeats_removed(documents(spark), width=width, digest=True).select("doc_id", "kept_sha256").collect()
    assert Counter(tuple(r) for r in digests) == Counter((d, hashlib.sha256(t.encode()).hexdigest()) for d, _, _, t in want.elements())
    assert repeats_removed(empty(spark)).count() == 0
    with pytest.raises(ValueError):
        repeats_removed(empty(spark), width=2)


def test_settled_rows_of_pieces_are_not_grouped_together(spark):
    """Every piece holds the same passage, so all have the same settled hashes; each is a group of its own."""
    passage = " ".join(f"w{i}" for i in range(40))
    docs = local_table(spark, [(i, f"a{i} {passage} b{i}") for i in range(120)], "id long, text string").repartition(6)
    batch = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        sent = block_anchors._anchor_lists(docs, 7, 48)
        found = sent.where("bucket < 0").groupBy("bucket").count().collect()
        assert len(found) >= 24 and all(r["count"] == 1 for r in found)
        anchors = block_anchors._gathered(sent.groupBy("bucket").applyInArrow(block_anchors._anchors, block_anchors.FOUND))
        sent = block_anchors._window_lists(docs.join(anchors, "id", "left").repartition(6), 13, 7, 48)
        found = sent.where("bucket < 0").groupBy("bucket").count().collect()
        assert len(found) >= 24 and all(r["count"] == 1 for r in found)
        got = repeats_removed(docs.withColumnRenamed("id", "doc_id"))
        assert {(r.doc_id, r.n_removed) for r in got.collect()} == {(i, 40 if i else 0) for i in range(120)}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)


def items_table(spark):
    some = [t for t in texts() if t]
    rows = [(10, some[1][:300]), (2, some[2]), (2, some[2]), (3, "one two"), (4, "changed"), (5, None), (6, ""), (7, "KAN, kar!"), (None, some[4]), (8, "absent words here")]
    return local_table(spark, rows, "item_id long, text string")


def brute_matches(rows, items, window):
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    wins = {}
    for item, text in items:
        w = re.findall(pattern, low(text))
        n = min(window, len(w))
        for i in range(len(w) - n + 1) if w else []:
            wins.setdefault(tuple(w[i:i + n]), set()).add(item)
    for doc, text in rows:
        w = re.findall(pattern, low(text))
        hit, names = set(), set()
        for n in {len(k) for k in wins}:
            for i in range(len(w) - n + 1):
                found = wins.get(tuple(w[i:i + n]))
                if found:
                    hit |= set(range(i, i + n))
                    names |= {str(x) for x in found if x is not None}
        yield doc, len(w), hit, sorted(names)


@pytest.mark.parametrize("shard_bytes", [1 << 20, 300])
def test_decontaminate(spark, shard_bytes):
    items = items_table(spark)
    want = list(brute_matches(documents(spark).select("doc_id", "text").collect(), items.collect(), 6))
    found = dec.benchmark_matches(documents(spark), items, window=6, shard_bytes=shard_bytes).select("row.doc_id", "n_words", dec.hit_words(), "items").collect()
    assert Counter((d, n, h, tuple(i)) for d, n, h, i in found) == Counter((d, n, len(h), tuple(i)) for d, n, h, i in want)
    assert any(len(h) > 6 for _, _, h, _ in want)


def test_contaminated_spans_go(spark):
    items = items_table(spark)
    want = {(d, n): h for d, n, h, _ in brute_matches(documents(spark).select("doc_id", "text").collect(), items.collect(), 6)}
    clean = dec.decontaminate(documents(spark), items, window=6, max_coverage=0.5)
    assert clean.columns == documents(spark).columns
    assert clean.count() == sum(len(h) <= 0.5 * n for _, n, h, _ in brute_matches(documents(spark).select("doc_id", "text").collect(), items.collect(), 6))
    before = {(r.doc_id, r.n_chars): r.text for r in documents(spark).collect()}
    for r in clean.where("doc_id is not null").collect():
        text = before[(r.doc_id, r.n_chars)]
        n = len(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(text)))
        if not want[(r.doc_id, n)]:
            assert r.text == text
        else:
            assert len(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(r.text))) == n - len(want[(r.doc_id, n)])
    assert dec.contamination(empty(spark), items).count() == 0
    nothing = dec.contamination(documents(spark), items.limit(0))
    assert nothing.where("contaminated or n_items > 0").count() == 0 and nothing.count() == documents(spark).count()


def line_dedup(rows, chunkings):
    """What the operator gives, from chunks of texts."""
    cut, first = {}, {}
    for doc, text in rows:
        if text is None or doc is None:
            continue
        lines, cut[(doc, text)] = text.split("\n"), []
        h = [int(hashlib.md5(x.encode()).hexdigest()[:8], 16) for x in lines] + [0, 0]
        for c in range(chunkings):
            start = 0
            for i in range(len(lines)):
                value = h[i + 1] + 31 * h[i + 2 if i + 2 < len(h) else -1] if c % 2 else h[i] + 31 * (h[i - 1] if i else 0)
                if not value >> c // 2 & 1 or i == len(lines) - 1:
                    if i > start:
                        chunk = tuple(lines[start:i + 1])
                        cut[(doc, text)].append((start, chunk))
                        first[chunk] = min(first.get(chunk, (doc, start)), (doc, start))
                    start = i + 1
    want = Counter()
    for doc, text in rows:
        gone = {start + k for start, chunk in cut.get((doc, text), []) if first[chunk] < (doc, start) for k in range(len(chunk))}
        lines = [] if text is None else text.split("\n")
        want[(doc, len(lines), len(gone), "\n".join(x for i, x in enumerate(lines) if i not in gone) if gone else text)] += 1
    return want


def test_line_chunks(spark):
    rows = documents(spark).select("doc_id", "text").collect()
    want = line_dedup(rows, 5)
    got = Counter(tuple(r) for r in line_chunks.lines_deduplicated(documents(spark), chunkings=5).collect())
    assert got == want
    assert any(n for _, _, n, _ in want)
    assert line_chunks.lines_deduplicated(empty(spark)).count() == 0


def test_automaton_matches_are_longest():
    import random
    rng = random.Random(5)
    for _ in range(40):
        items = [(str(i), " ".join(rng.choice("abc") for _ in range(rng.randint(1, 9)))) for i in range(4)]
        text = " ".join(rng.choice("abcd") for _ in range(60))
        machine = dec.Automaton(items, 4)
        data = np.frombuffer(text.encode(), np.uint8)
        words = dec.words_of(data, np.array([0, len(data)]), dec.ALNUM)
        known = dec.member(dec.word_hashes(data, words), machine.hashes)
        at, names = machine.search(data, words, known, 0, len(words.starts))
        (_, _, hit, want), = brute_matches([(0, text)], items, 4)
        assert {i for a, b in at for i in range(a, b + 1)} == hit and sorted(names) == want


def test_columns_of_any_name_pass(spark):
    odd = documents(spark).withColumn("hits", F.lit(1)).withColumn("items", F.lit(2)).withColumn("clean", F.lit(3))
    assert dec.decontaminate(odd, items_table(spark)).columns == odd.columns


def test_line_chunks_of_passages(spark):
    """Shared passages go where they stand a second time, whatever stands around them; their first copy and all else stays."""
    rng = random.Random(4)
    line = lambda: " ".join(rng.choice("abcdefgh") * rng.randrange(1, 9) for _ in range(8)) + str(rng.random())
    rows, hit, total = [], 0, 0
    passages = [[line() for _ in range(8 + k % 5)] for k in range(40)]
    for copy in range(3):
        for k, passage in enumerate(passages):
            rows.append((copy * 100 + k, "\n".join([line() for _ in range(rng.randrange(5))] + passage + [line() for _ in range(rng.randrange(5))])))
    got = line_chunks.lines_deduplicated(local_table(spark, rows, "doc_id bigint, text string")).collect()
    assert Counter(map(tuple, got)) == line_dedup(rows, 12)
    left = {r.doc_id: set(r.text.split("\n")) for r in got}
    for doc, text in rows:
        own = set(passages[doc % 100])
        assert set(text.split("\n")) - own <= left[doc] and (doc >= 100 or own <= left[doc])
        hit, total = (hit + len(own - left[doc]), total + len(own)) if doc >= 100 else (hit, total)
    assert hit >= 0.9 * total


def test_lines_that_share_hashes_are_compared(spark, monkeypatch):
    """With hashes of the length only, different lines meet, and none of them goes."""
    rows = [(1, "ab\ncd\nsame one\nsame two!"), (2, "xy\nzw\nsame one\nsame two!"), (3, "other line\nsame one\nsame two!")]
    monkeypatch.setattr(line_chunks, "line_keys", lambda x: F.struct(F.length(x).cast("long").alias("a"), F.length(x).cast("long").alias("b")))
    got = {r.doc_id: r.text.split("\n") for r in line_chunks.lines_deduplicated(local_table(spark, rows, "doc_id bigint, text string")).collect()}
    assert got[1] == ["ab", "cd", "same one", "same two!"] and got[2][:2] == ["xy", "zw"] and got[3][0] == "other line"
