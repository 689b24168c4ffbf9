"""Exact quantiles of many columns at once, without sorting or collecting a column.

Spark's exact ``percentile`` keeps every distinct value of a column in one buffer. Here an approximate pass gives,
for each wanted position, two values that enclose it; a second pass counts below and between them. Only the values
strictly between are gathered, once they are known to be few; otherwise the enclosure is narrowed again.
"""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

# The sketch of a column has some multiple of this many entries; wide tables get smaller ones.
ACCURACY, WIDE_ACCURACY, WIDE = 10_000, 2_000, 100
# Values gathered at once, over all columns.
GATHER = 1_000_000


def exact_quantiles(df: DataFrame, columns: dict[str, Column], probs: list[float], accuracy: int | None = None,
                    gather: int = GATHER, delta: float | None = None) -> dict[str, list[float | None]]:
    """Quantiles with linear interpolation of double expressions, NULLs ignored.

    ``columns`` maps result names to expressions without NaN. Two scans; one or two more above about 10^8 rows.
    """
    names = list(columns)
    if not names:
        return {}
    x = df.select(*[columns[n].alias(f"x{i}") for i, n in enumerate(names)])
    accuracy = accuracy or (ACCURACY if len(names) <= WIDE else WIDE_ACCURACY)
    delta = delta or 2 / accuracy
    first = x.agg(*[e for i in range(len(names)) for e in (
        F.count(f"x{i}").alias(f"n{i}"), F.min(f"x{i}").alias(f"lo{i}"), F.max(f"x{i}").alias(f"hi{i}"),
        F.percentile_approx(f"x{i}", [p for q in probs for p in (max(q - delta, 0.0), min(q + delta, 1.0))],
                            accuracy).alias(f"p{i}"))]).first()
    counts = [first[f"n{i}"] for i in range(len(names))]
    # A position is a 0-based rank; each quantile needs the ranks on both sides of q * (n - 1).
    value: dict[tuple[int, int], float] = {}
    enclosure: dict[tuple[int, int], tuple[float, float]] = {}
    for i, n in enumerate(counts):
        for j, prob in enumerate(probs):
            for rank in {math.floor(prob * (n - 1)), math.ceil(prob * (n - 1))} if n else ():
                if rank == 0 or rank == n - 1:
                    value[i, rank] = first[f"lo{i}"] if rank == 0 else first[f"hi{i}"]
                else:
                    enclosure[i, rank] = tuple(first[f"p{i}"][2 * j:2 * j + 2])
    # The sketch errs by at most n / accuracy ranks per bound, so small columns finish in this pass.
    few = max(counts) * (2 * delta + 2 / accuracy) * len(enclosure) <= gather
    while enclosure:
        spans = sorted({(i, lo, hi) for (i, _), (lo, hi) in enclosure.items()})
        slot = {s: k for k, s in enumerate(spans)}
        exprs = []
        for (i, lo, hi), k in slot.items():
            c = F.col(f"x{i}")
            inside = (c > lo) & (c < hi)
            exprs += [F.count_if(c < lo).alias(f"below{k}"), F.count_if(c == lo).alias(f"low{k}"),
                      F.count_if(inside).alias(f"mid{k}"), F.count_if(c == hi).alias(f"high{k}")]
            if few:
                exprs.append(F.collect_list(F.when(inside, c)).alias(f"v{k}"))
        counted = x.agg(*exprs)
        if few:
            wanted = [(key, slot[(key[0], *span)]) for key, span in enclosure.items()]
            counted = counted.select("*", *[
                F.get(F.sort_array(f"v{k}"), (F.lit(rank) - F.col(f"below{k}") - F.col(f"low{k}")).cast("int")).alias(f"r{i}_{rank}")
                for (i, rank), k in wanted]).drop(*[f"v{k}" for k in slot.values()])
        row = counted.first()
        narrower = {}
        for (i, rank), (lo, hi) in enclosure.items():
            k = slot[i, lo, hi]
            below, low, mid = row[f"below{k}"], row[f"low{k}"], row[f"mid{k}"]
            high = row[f"high{k}"] if hi != lo else 0
            if rank < below or rank >= below + low + mid + high:
                return exact_quantiles(df, columns, probs, accuracy, gather, 10 * delta)
            elif rank < below + low:
                value[i, rank] = lo
            elif rank >= below + low + mid:
                value[i, rank] = hi
            elif few:
                value[i, rank] = row[f"r{i}_{rank}"]
            else:
                narrower[i, rank] = (lo, hi, (rank - below - low) / mid, mid)
        if not few and narrower:
            narrower, few = _narrow(x, narrower, accuracy, gather)
        enclosure = narrower
    out = {}
    for i, name in enumerate(names):
        n = counts[i]
        out[name] = [_between(value, i, prob * (n - 1)) if n else None for prob in probs]
    return out


def _narrow(x: DataFrame, spans: dict, accuracy: int, gather: int) -> tuple[dict, bool]:
    """Encloses each rank more tightly by a sketch over the values strictly inside its old span."""
    delta = 2 / accuracy
    row = x.agg(*[
        F.percentile_approx(F.when((F.col(f"x{i}") > lo) & (F.col(f"x{i}") < hi), F.col(f"x{i}")),
                            [max(at - delta, 0.0), min(at + delta, 1.0)], accuracy).alias(f"p{k}")
        for k, ((i, _), (lo, hi, at, _)) in enumerate(spans.items())]).first()
    tight = {key: tuple(row[f"p{k}"]) for k, key in enumerate(spans)}
    return tight, sum(s[3] for s in spans.values()) * 6 / accuracy <= gather


def _between(value: dict, i: int, position: float) -> float:
    low, high = value[i, math.floor(position)], value[i, math.ceil(position)]
    if low == high:
        return low
    return low + (position - math.floor(position)) * (high - low)
