import re

import numpy as np
import pyarrow as pa

from edge import texts
from sluice.llm.words import (ALNUM, BLOCK, SPACED, bucket_slices, lower_ascii, member, mix, order_pairs, pack, pack_small, pieces, unpack, unpack_small,
                              whole, windows, word_hashes, words_of)


def test_words_are_those_of_the_patterns():
    values = texts() + ["word" * BLOCK + " tail", "é" * BLOCK]
    for size in (50, 1 << 20):
        seen = {}
        for piece in pieces(pa.array(values), size):
            low = lower_ascii(piece.data)
            for members, pattern in ((SPACED, r"[^\x20\x09-\x0D]+"), (ALNUM, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")):
                words = words_of(low, piece.offsets, members)
                hashes = [word_hashes(low, words, k) for k in (0, 1)]
                for row in range(piece.lo, piece.hi):
                    folded = re.sub("[A-Z]", lambda m: m[0].lower(), values[row] or "")
                    a, b = words.firsts[row - piece.lo:row - piece.lo + 2]
                    want = re.findall(pattern, folded)
                    assert [low[s:e].tobytes().decode() for s, e in zip(words.starts[a:b], words.ends[a:b])] == want
                    for word, h, g in zip(want, hashes[0][a:b], hashes[1][a:b]):
                        assert seen.setdefault(word, (h, g)) == (h, g)
        assert len(set(seen.values())) == len(seen)


def test_windows_stay_in_rows():
    piece = next(pieces(pa.array(["a b c", "d e", "", "a b c"])))
    words = words_of(piece.data, piece.offsets, SPACED)
    starts = whole(words, 3)
    assert starts.tolist() == [0, 5]
    found = windows(word_hashes(piece.data, words), 3)[starts]
    assert found[0] == found[1]


def test_packed_numbers_come_back():
    numbers = np.sort(mix(np.arange(1, 5000, dtype=np.uint64)))
    assert (unpack(pack(numbers)) == numbers).all()
    assert len(unpack(pack(numbers[:0]))) == 0
    small = np.array([0, 5, 1 << 31, 3])
    assert unpack_small(pack_small(small)).tolist() == small.tolist()
    cuts = list(bucket_slices(numbers, 7))
    assert [b for b, _, _ in cuts] == list(range(7)) and cuts[-1][2] == len(numbers) and list(bucket_slices(numbers[:0], 7)) == []
    assert member(numbers[:9], numbers[4:]).tolist() == [False] * 4 + [True] * 5 and not member(numbers, numbers[:0]).any()


def test_order_by_two():
    v, s = np.array([3, 1, 3, 2, 1], np.uint64), np.array([5, 9, 1, 0, 2])
    assert order_pairs(v, s).tolist() == np.lexsort((s, v)).tolist()
