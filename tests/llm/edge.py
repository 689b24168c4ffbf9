"""Small tables with everything awkward: NULLs, empty and very long texts, repeated rows, clashing extra columns."""
import random

from sluice.session import local_table

WORDS = [a + b for a in "ka lo mi ru te so".split() for b in "n r s t ka lo mi".split()]


def text_of(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "", ",", ".\n"]) for _ in range(n))


def texts(seed=1, n=60):
    rng = random.Random(seed)
    base = [text_of(rng, rng.choice([3, 30, 80, 150])) for _ in range(n)]
    passage = text_of(rng, 40)
    out = list(base)
    for i in range(0, n, 3):
        words = base[i].split(" ")
        words[len(words) // 2] = "changed"
        out.append(" ".join(words))
    out += [base[1], base[1], base[1].upper(), base[2] + " " + passage, passage + " " + base[4], base[5][:40] + "\n" + passage]
    out += ["", None, "one", "one two", "one  two\t", "ONE TWO", "é ü ñ ß", "\n\n\n", " ", "a b c d"]
    out.append(" ".join([text_of(rng, 2000), passage, "again " * 3000, text_of(rng, 30000)]))
    return out


def documents(spark, values=None, seed=1):
    """Ids in no order of size, two rows equal, two rows with NULL ids, sources with NULL, and names that operators use inside."""
    values = texts(seed) if values is None else values
    rows = [((i * 37) % 1009, t, "en", None if i % 7 == 0 else f"s{min(i % 5, 2)}", len(t) if t is not None else None, "x", 1, None) for i, t in enumerate(values)]
    if rows:
        rows += [rows[-1], (None, values[0], None, "s0", None, None, None, None), (None, None, None, None, None, None, None, None)]
    return local_table(spark, rows, "doc_id long, text string, lang string, source string, n_chars long, node string, shard int, row string")


def empty(spark):
    return documents(spark, []).limit(0)
