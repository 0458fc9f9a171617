"""Benchmark decontamination: size-partitioned MinHash containment search, DataFrame only.

A test item is represented by its least shingle hashes. How many are kept depends on its size:
of an item with n shingles that a document contains to the share t, at most n - ceil(t n) are
missing, so of the n - ceil(t n) + 1 least hashes one is in the document. Items are partitioned
by size; each partition knows the largest hash that it keeps, and a document drops all hashes
above the limits of those partitions whose items could fit in it. What is left is joined with
the kept hashes, however long the document, and the pairs found are verified by counting the
item's shingles in the document's text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import written

SIZE = 5
SHARE = 75
#: Kept hashes up to this many may be sent to all executors; more are joined by a shuffle.
BROADCAST_HASHES = 500_000

#: ASCII white space ends a word, as everywhere in this package.
WORDS = r"filter(split(lower(coalesce(text, '')), '[ \\t\\n\\x0B\\f\\r]+'), w -> w <> '')"


def _words(df: DataFrame) -> DataFrame:
    return df.withColumn("w", F.expr(WORDS))


def _hashes(size: int) -> str:
    """The distinct shingle hashes of the words ``w``; fewer words than ``size`` are one shingle."""
    items = ", ".join(f"h[i + {k}]" for k in range(size))
    return (
        f"array_distinct(transform(array(transform(w, x -> xxhash64(x))), h -> "
        f"CASE WHEN size(h) >= {size} THEN transform(sequence(0, size(h) - {size}), i -> xxhash64({items})) "
        f"WHEN size(h) > 0 THEN array(xxhash64(h, size(h))) ELSE cast(array() as array<bigint>) END)[0])"
    )


def _texts(size: int) -> str:
    """The distinct shingles themselves, joined by spaces.

    The words are bound to a name of their own: a filter on the result is moved below them by
    the optimizer, which would otherwise split the text again for every shingle.
    """
    return (
        f"array_distinct(transform(array(w), v -> CASE WHEN size(v) >= {size} "
        f"THEN transform(sequence(1, size(v) - {size} + 1), i -> array_join(slice(v, i, {size}), ' ')) "
        f"WHEN size(v) > 0 THEN array(array_join(v, ' ')) ELSE cast(array() as array<string>) END)[0])"
    )


def item_sketches(items: DataFrame, size: int = SIZE, share: int = SHARE) -> DataFrame:
    """item_id, n (shingles), part (by size), hash: one row per kept hash of an item."""
    hashed = _words(items.select("item_id", "text").where("item_id IS NOT NULL")).withColumn("s", F.expr(f"array_sort({_hashes(size)})"))
    kept = f"slice(s, 1, CAST(size(s) - ceil(size(s) * {share} / 100.0) + 1 AS INT))"
    return hashed.where("size(s) > 0").select(
        "item_id", F.size("s").alias("n"), F.expr("CAST(floor(log2(size(s))) AS INT)").alias("part"), F.explode(F.expr(kept)).alias("hash")
    )


def contained(docs: DataFrame, items: DataFrame, size: int = SIZE, share: int = SHARE) -> DataFrame:
    """Pairs of a document and a test item that it contains to ``share`` percent or more.

    ``docs`` has doc_id and text, ``items`` item_id and text. Returns doc_id, item_id, n_item
    (distinct word shingles of the item), n_found (those in the document), containment.

    The search misses no such pair: the kept hashes follow from the share. Null and empty texts
    have no shingles and neither contain nor are contained; items of fewer than ``size`` words
    are found in documents with just these words. Rows without an id take no part. Repeated
    rows give one row per pair; of an id with several texts the fullest containment counts.
    Ties cannot arise. Texts are searched whole, at any length. Empty tables give an empty
    result. Other columns are ignored.
    """
    sketches = written(item_sketches(items, size, share), "sketches")
    # One row per power of two between the shortest and the longest item.
    parts = sketches.groupBy("part").agg(F.min("n").alias("n"), F.max("hash").alias("top"), F.count("*").alias("c")).collect()
    limit = " ".join(f"WHEN size(s) >= {-(-share * low // 100)} THEN {top}" for low, top in _limits(parts))
    limit = f"CASE {limit} END" if limit else "CAST(NULL AS BIGINT)"
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id IS NOT NULL")
    hashed = _words(texts).select("doc_id", F.expr(_hashes(size)).alias("s"))
    low = hashed.select("doc_id", F.explode(F.expr(f"transform(array({limit}), t -> filter(s, x -> x <= t))[0]")).alias("hash"))
    few = sum(p["c"] for p in parts) <= BROADCAST_HASHES
    keys = sketches.select("item_id", "hash")
    pairs = low.join(F.broadcast(keys) if few else keys, "hash").select("doc_id", "item_id").distinct()
    pairs = written(pairs, "pairs")
    wanted = _words(items.select("item_id", "text").where("item_id IS NOT NULL")).select("item_id", F.expr(_texts(size)).alias("item_shingles"))
    by_item = pairs.join(wanted, "item_id")
    found = _words(texts.join(by_item, "doc_id")).select(
        "doc_id", "item_id", F.size("item_shingles").alias("n_item"), F.expr(f"size(array_intersect(item_shingles, {_texts(size)}))").alias("n_found")
    )
    found = found.where(F.expr(f"n_found * 100 >= n_item * {share}"))
    best = found.groupBy("doc_id", "item_id").agg(F.max(F.struct(F.col("n_found") / F.col("n_item"), "n_found", "n_item")).alias("b"))
    return best.select(
        "doc_id", "item_id", F.col("b.n_item").cast("long").alias("n_item"), F.col("b.n_found").cast("long").alias("n_found"),
        (F.col("b.n_found") / F.col("b.n_item")).alias("containment"),
    )


def _limits(parts) -> list[tuple[int, int]]:
    """(least item size, largest hash of all items down from there), longest items first."""
    out, rising = [], None
    for p in sorted(parts, key=lambda p: p["n"]):
        rising = p["top"] if rising is None else max(rising, p["top"])
        out.append((p["n"], rising))
    return out[::-1]


def without_items(docs: DataFrame, items: DataFrame, size: int = SIZE, share: int = SHARE) -> DataFrame:
    """The rows of ``docs`` that contain no test item, unchanged; see ``contained``.

    Rows without a doc_id stay. All rows of a doc_id go if one of its texts contains an item.
    """
    leaked = contained(docs, items, size, share).select("doc_id").distinct()
    return docs.join(written(leaked, "leaked"), "doc_id", "left_anti").select(docs.columns)


ORACLE = r"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS w
  FROM documents WHERE doc_id IS NOT NULL
), i AS (
  SELECT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS w
  FROM benchmark WHERE item_id IS NOT NULL
), ds AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5
    THEN list_transform(range(1, len(w) - 3), lambda k: array_to_string(w[k:k + 4], ' ')) ELSE [array_to_string(w, ' ')] END) AS s
  FROM d WHERE len(w) > 0
), i_s AS (
  SELECT DISTINCT item_id, unnest(CASE WHEN len(w) >= 5
    THEN list_transform(range(1, len(w) - 3), lambda k: array_to_string(w[k:k + 4], ' ')) ELSE [array_to_string(w, ' ')] END) AS s
  FROM i WHERE len(w) > 0
), n AS (SELECT item_id, count(*) AS n_item FROM i_s GROUP BY item_id),
c AS (SELECT doc_id, item_id, count(*) AS n_found FROM ds JOIN i_s USING (s) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, n_item, n_found, n_found / n_item AS containment
FROM c JOIN n USING (item_id) WHERE n_found * 100 >= n_item * 75
"""
