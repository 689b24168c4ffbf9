"""Token alignment against loops over whole encodings, and the galloping search against bisection."""
import hashlib
import random
from bisect import bisect_left
from collections import Counter

import numpy as np
import pytest

from edge import documents, empty, texts
from sluice.llm import alignment
from sluice.llm.alignment import BYTE_LEVEL, PIECES, Units, align, aligned, gallop, token_alignment, vocabularies
from sluice.session import local_table


def test_gallop_is_bisection():
    rng = random.Random(3)
    for n in (1, 2, 7, 1000):
        longer = np.array(sorted(rng.sample(range(3 * n), n)))
        cuts = sorted(rng.sample(range(n + 1), min(n, 3)))
        values, guess, begin, stop = [], [], [], []
        for lo, hi in [*zip(cuts, cuts[1:]), (0, n), (n, n)]:
            for v in range(-1, 3 * n + 2):
                values.append(v), guess.append(rng.randrange(-1, n + 2)), begin.append(lo), stop.append(hi)
        found = gallop(*map(np.array, (values, guess, begin, stop)), longer)
        assert found.tolist() == [bisect_left(longer.tolist(), v, b, e) for v, b, e in zip(values, begin, stop)]


def links_and_groups(a, b):
    """Of tokens as (id, bytes): every overlapping pair, and the groups between common ends."""
    spans = []
    for side in (a, b):
        at, out = 0, []
        for i, x in side:
            out.append((i, at, at + len(x)))
            at += len(x)
        spans.append(out)
    links = [(i, j) for i, s, e in spans[0] for j, t, f in spans[1] if s < f and t < e]
    common = sorted({e for _, _, e in spans[0]} & {e for _, _, e in spans[1]})
    groups, lo = [], 0
    for hi in common:
        groups.append("|".join(",".join(str(i) for i, s, _ in side if lo <= s < hi) for side in spans))
        lo = hi
    return links, groups


def test_align_random_cuts():
    rng = random.Random(5)
    sides, firsts, want, at = ([], []), ([0], [0]), [], 0
    for _ in range(300):
        size = rng.choice([1, 2, 5, 30, 200])
        unit = []
        for k in range(2):
            ends = sorted({*rng.sample(range(1, size + 1), rng.randint(1, size)), size})
            unit.append([(len(sides[k]) + i, b"x" * (e - s)) for i, (s, e) in enumerate(zip([0, *ends], ends))])
            sides[k].extend(at + e for e in ends)
            firsts[k].append(len(sides[k]))
        at += size
        want.append(links_and_groups(*unit))
    a, b, x, y = align(np.array(sides[0]), np.array(firsts[0]), np.array(sides[1]), np.array(firsts[1]))
    assert list(zip(a.tolist(), b.tolist())) == [p for links, _ in want for p in links]
    assert list(zip((x + 1).tolist(), (y + 1).tolist())) == [(int(g.split("|")[0].split(",")[-1]) + 1, int(g.split("|")[1].split(",")[-1]) + 1) for _, groups in want for g in groups]


AWKWARD = ["", None, " ", "  ", "a", "a ", " a", "a  b", "a\n b \t c", "a \n\nb", "<|endoftext|> <s> <0x41> </s><unk>", "un▁der", "café naïve ß", "日本語 の text", "\U0001f600 \U0001f468‍\U0001f469 ok",
           "it's we'll I'm 's", "x\x00y z", "  nbsp here", "é combining", "\x85next  line", "12 345.67,8 -9", "tab\tand  two   three    spaces", "﻿bom", "a\r\nb", "ẛ̣ ﬁ ①", "$$ ## !! ''",
           "word " * 3000, "no" * 3000, " " * 5000, "é" * 2000]


def brute(rows):
    known = vocabularies(BYTE_LEVEL, PIECES)
    found = []
    for i, t in rows:
        a = known.a.encode(" " + t, add_special_tokens=False).ids if t else []
        b = known.b.encode(t) if t else []
        a, b = [(k, known.bytes_a[k]) for k in a], [(k, known.bytes_b[k]) for k in b]
        if not t or any(b"".join(x for _, x in side) != (" " + t).encode() for side in (a, b)):
            a = b = []
        found.append((i, a, b, *links_and_groups(a, b)))
    held = Counter(p for *_, links, _ in found for p in set(links))
    most = {}
    for (a, _), n in held.items():
        most[a] = max(most.get(a, 0), n)
    return sorted(((i, len(a), len(b), len(groups), len(links), hashlib.sha256(";".join(groups).encode()).hexdigest() if a else "", sum(held[p] == most[p[0]] for p in links), sum(held[p] for p in links))
                   for i, a, b, links, groups in found), key=repr)


def found_in(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("block,piece,units,partitions", [(16 << 20, 2 << 20, 200_000, 3), (2000, 500, 50, 5)])
def test_token_alignment(spark, monkeypatch, block, piece, units, partitions):
    monkeypatch.setattr(alignment, "BLOCK_BYTES", block)
    monkeypatch.setattr(alignment, "PIECE_BYTES", piece)
    monkeypatch.setattr(alignment, "MAX_UNITS", units)
    short = [t for t in texts(7, 20) if not t or len(t) < 3000]
    rows = [(i, t) for i, t in enumerate(short + AWKWARD)] + [(3, short[3]), (None, "no id"), (None, None)]
    docs = local_table(spark, [(i, t, "x", 1) for i, t in rows], "doc_id long, text string, block string, n_a int").repartition(partitions)
    assert found_in(token_alignment(docs)) == brute(rows)


def test_units_encode_as_whole_texts(spark):
    """Cutting changes no token in the documents that are given."""
    known = vocabularies(BYTE_LEVEL, PIECES)
    assert known.cut
    rows = [r[0] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect() if r[0]]
    for text in rows + [t for t in AWKWARD if t]:
        a, b = known.encode(known.units(text))
        assert [i for x in a for i in x] == known.a.encode(" " + text, add_special_tokens=False).ids
        assert [i for x in b for i in x] == known.b.encode(text)


def test_whole_texts_where_entries_cross(spark, monkeypatch):
    known = vocabularies(BYTE_LEVEL, PIECES)
    values = [t for t in AWKWARD if not t or len(t) < 3000]
    cut = aligned(values, Units(known))
    monkeypatch.setattr(known, "cut", False)
    whole = aligned(values, Units(known))
    assert cut[1] == whole[1] and all((x == y).all() for x, y in zip(cut, whole) if x is not cut[1])


def test_long_stretches():
    """A million spaces, letters and signs each."""
    for unit in (" ", "a", "?", "\n"):
        counts, digests, *_ = aligned([unit * 1_000_000], Units(vocabularies(BYTE_LEVEL, PIECES)))
        assert len(digests[0]) in (0, 64) and (counts >= 0).all()


def test_awkward_tables(spark):
    assert token_alignment(empty(spark)).count() == 0
    docs = documents(spark)
    assert token_alignment(docs).count() == docs.count()
