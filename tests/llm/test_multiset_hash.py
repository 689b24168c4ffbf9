"""Multiset hashes against plain Python sums, and the order of the documents against a sorted list."""
import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from edge import documents, empty, text_of, texts
from sluice.llm import multiset_hash as hashing
from sluice.llm.multiset_hash import added, edited_fingerprints, fingerprint, fingerprints, likeness, removed, texts_vectors, unpacked
from sluice.session import local_table

WHITE = " \t\n\x0b\x0c\r"


def units(text):
    """The runs of three words of each paragraph, and the paragraphs."""
    found = Counter()
    for line in (text.split("\n") if text else []):
        for c in WHITE:
            line = line.replace(c, " ") if c != "\n" else line
        words = line.split(" ")
        words = [w for w in words if w]
        found.update(zip(words, words[1:], words[2:]))
    found.update(("line", x) for x in (text.split("\n") if text else []))
    return found


def exact_likeness(a, b):
    x, y = units(a), units(b)
    total = sum(v * v for v in x.values()) + sum(v * v for v in y.values())
    return 1 - sum((x[u] - y[u]) ** 2 for u in x | y) / total if total else 1.0


def one(text):
    return unpacked([fingerprint(text)])


def test_sum_of_paragraphs_in_any_order():
    rng = random.Random(4)
    lines = [text_of(rng, rng.choice([0, 1, 2, 5, 40])).replace("\n", " ") for _ in range(50)] + ["", "", "same", "same", "é ü", "?!"]
    whole = fingerprint("\n".join(lines))
    rng.shuffle(lines)
    assert fingerprint("\n".join(lines)) == whole
    total, blank = fingerprint(None), fingerprint("\n")  # two empty paragraphs
    for line in lines:
        total = added(total, fingerprint(line) if line else removed(fingerprint("same\n"), fingerprint("same")))
    assert total == whole and blank == added(*[removed(fingerprint("same\n"), fingerprint("same"))] * 2)
    cut = removed(whole, fingerprint("same"))
    assert cut == fingerprint("\n".join([x for x in lines if x != "same"] + ["same"]))
    assert added(cut, fingerprint("same")) == whole and cut != whole


def test_equal_only_for_equal_multisets():
    values = ["", "a", "A", "a\n", "\na", "a\na", "a b c", "a b\nc", "c\na b", "a b c ", "?", "!", "\n", "\n\n", "é", "e", "a" * 1000, "a" * 1001]
    by = {}
    for v in values:
        by.setdefault(fingerprint(v), set()).add(tuple(sorted(v.split("\n"))) if v else ())
    assert all(len(kinds) == 1 for kinds in by.values())
    assert len(by) == len({tuple(sorted(v.split("\n"))) if v else () for v in values})
    assert fingerprint(None) == fingerprint("")


@pytest.mark.parametrize("rows", [1, 7, 4096])
def test_batches_do_not_matter(monkeypatch, rows):
    monkeypatch.setattr(hashing, "ROWS", rows)
    values = texts(2)
    seals, lanes = texts_vectors(pa.array(values, pa.string()))
    alone = unpacked([fingerprint(t) for t in values])
    assert (seals == alone[0]).all() and (lanes == alone[1]).all()


def test_likeness_estimates_shared_runs():
    rng = random.Random(8)
    base = [text_of(rng, 400) for _ in range(60)]
    errors = []
    for a, b in zip(base, base[1:]):
        for keep in (0.0, 0.3, 0.7, 0.95):
            cut = int(len(a) * keep)
            c = a[:cut] + b[cut:]
            errors.append((1 - exact_likeness(a, c), likeness(one(a), one(c))[0] - exact_likeness(a, c)))
    assert max(abs(e) for _, e in errors) < 0.4
    assert np.mean([abs(e) for far, e in errors if far < 0.1]) < 0.02
    assert abs(np.mean([e for far, e in errors if far < 0.8])) < 0.03
    long = "again " * 300_000
    assert likeness(one(long), one(long))[0] == 1.0
    assert abs(likeness(one(long), one(long[:len(long) // 2]))[0] - 0.8) < 0.001  # 2xy / (x^2 + y^2) at y = x / 2
    assert likeness(one(""), one(None))[0] == 1.0 and likeness(one(""), one("a"))[0] == 0.0 and likeness(one("?"), one("!"))[0] < 1


def brute(rows):
    order = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0)))
    for (i, a), (_, b) in zip(order, order[1:] + order[:1]):
        e = a[:len(a) - len(a) // 2] + b[:len(a) // 2]
        yield i, len(a), hashlib.sha256(e.encode()).hexdigest(), fingerprint(a), fingerprint(e), likeness(one(a), one(e))[0], likeness(one(a), one(b))[0]


def found_in(df):
    return sorted((tuple(bytes(v) if isinstance(v, bytearray) else v for v in r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("parts", [1, 3])
def test_next_documents(spark, parts):
    values = texts(3)
    docs = local_table(spark, [((i * 37) % 1009, t, "x") for i, t in enumerate(values)], "doc_id long, text string, key string").repartition(parts)
    assert found_in(edited_fingerprints(docs)) == sorted(brute([((i * 37) % 1009, t) for i, t in enumerate(values)]), key=repr)


def test_repeated_ids_and_rows(spark):
    """Equal rows follow each other; rows of one id go by a fixed order of their texts, whatever the partitions."""
    rows = [(5, "a b c d e f"), (5, "other text"), (9, "nine words"), (None, "no id"), (None, None), (-(1 << 63), "least id")] + [(7, f"text {i % 3} of seven") for i in range(300)]
    docs = lambda n: local_table(spark, rows, "doc_id long, text string").repartition(n)
    found = found_in(edited_fingerprints(docs(1)))
    assert found == found_in(edited_fingerprints(docs(13))) and len(found) == len(rows)
    assert Counter((r[0], r[1]) for r in found) == Counter((i, len(t or "")) for i, t in rows)
    same = [r for r in found if r[0] == 7]
    assert sum(r[6] == 1.0 for r in same) == 297
    assert sum(r[0] is None for r in found) == 2
    alone = found_in(edited_fingerprints(local_table(spark, [(1, "abcd")], "doc_id long, text string")))
    assert alone[0][:3] == (1, 4, hashlib.sha256(b"abab").hexdigest())


def test_awkward_tables(spark):
    docs = documents(spark)
    found = edited_fingerprints(docs)
    assert found.count() == docs.count() and edited_fingerprints(empty(spark)).count() == 0
    kept = fingerprints(docs.withColumnRenamed("node", "fingerprint"))
    assert kept.columns == [c for c in docs.columns if c != "node"] + ["fingerprint"]
    assert all(bytes(r["fingerprint"]) == fingerprint(r["text"]) for r in kept.collect())


def test_ranges_hold_every_key():
    rng = np.random.default_rng(1)
    ids = np.concatenate([rng.integers(-50, 50, 200), np.full(300, 7)])
    ranges = hashing.Ranges(sorted(ids[::5].tolist()), 4)
    null, h = rng.random(2000) < 0.1, rng.integers(-(1 << 63), (1 << 63) - 1, 2000)
    key = np.where(null, -1, ~rng.choice(ids, 2000))
    of = ranges.of(null, key, h)
    order = np.lexsort((h, key, null))
    assert (np.diff(of[order]) >= 0).all() and of.max() <= len(ranges.keys) + 4
    assert len(set(of[(key == ~7) & ~null].tolist())) > 20
