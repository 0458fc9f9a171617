"""Small tables with awkward rows, and brute-force versions to compare with."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts, first=0):
    """(doc_id, text) from a list of texts or of (doc_id, text)."""
    rows = [t if isinstance(t, tuple) else (first + i, t) for i, t in enumerate(texts)]
    return spark.createDataFrame([(i, t, "en", f"src{n % 3}", len(t or "")) for n, (i, t) in enumerate(rows)], SCHEMA)


def prose(seed: int, words: int) -> str:
    r = random.Random(seed)
    letters = "abcdefghijklmnoprstuvwz"
    return " ".join("".join(r.choices(letters, k=r.randint(2, 8))) for _ in range(words))


def edited(text: str, seed: int, changes: int) -> str:
    r, words = random.Random(seed), text.split()
    for _ in range(changes):
        words[r.randrange(len(words))] = "x" + str(r.randrange(10_000))
    return " ".join(words)


def awkward(spark):
    """Nulls, empty and very long texts, ties, repeated rows and clashing names of columns."""
    base = prose(1, 60)
    long = prose(2, 20_000)
    rows = [
        (1, base), (2, base), (3, edited(base, 5, 1)), (4, None), (5, ""), (6, " \t\n "), (7, "one two"), (8, "one two"),
        (9, long), (10, edited(long, 7, 30)), (None, base), (None, None), (11, prose(3, 80)), (11, prose(3, 80)), (12, "Ünïcode ✓ " * 40),
    ]
    df = documents(spark, rows)
    for name in ("n", "node", "a", "k", "h", "score", "rank", "token", "odds", "label", "s", "w", "item_id", "rate", "ids", "start", "root"):
        from pyspark.sql import functions as F

        df = df.withColumn(name, F.lit("clash"))
    return df


def shingles(text, size=5):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def component_of(rows, share=75):
    """doc_id -> least doc_id reachable, for (doc_id, text) rows with distinct ids."""
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= share * len(x | y):
                p, q = find(a), find(b)
                parent[max(p, q)] = min(p, q)
    return {i: find(i) for i in ids}
