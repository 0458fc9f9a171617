"""Importance resampling towards a target corpus, with a head and a tail vocabulary.

Features are runs of words, hashed by CRC-32 to buckets. The head vocabulary are the most
frequent words and pairs of the corpus: the CRC state behind each frequent word, and the bucket
of each frequent pair, are computed once and sent to all tasks. Features of the tail take their
CRC directly, a pair from the state behind its first word on. Both feed the same exact bucket
totals, so the choice of the head changes the time and never a result.

From the bucket totals of the corpus and of the target comes a gain per bucket; a document's
weight is the sum over its features, and adding Gumbel noise to the weights turns drawing
without replacement into taking the highest scores.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymark.operators.scan import numbered

from .store import ship, written

BUCKETS = 10_000
#: Words in the longest feature.
LONGEST = 1
#: Documents with fewer words are never drawn.
LEAST_WORDS = 20
#: Percent of the documents with enough words that are drawn.
SHARE = 10
SEED = 2024
#: Frequent words, and frequent pairs, in the head vocabulary; a longer feature is in the tail.
HEAD, HEAD_BYTES = 1 << 15, 64
CHUNK = 1 << 21

#: Bytes of words: digits, letters and all of other characters than ASCII; A-Z in lower case.
_KEPT = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words(text: bytes) -> list[bytes]:
    """The words of a text in UTF-8; blanks are the only white space left when it is split."""
    return text.translate(_KEPT).split()


@dataclass
class Head:
    """CRC states behind frequent words, and buckets of frequent pairs."""

    states: dict
    pairs: dict

    @classmethod
    def of(cls, features, buckets: int) -> Head:
        """From frequent words and pairs, the latter with a blank between their words."""
        single = [f for f in features if b" " not in f]
        pairs = [f for f in features if b" " in f]
        return cls({w: crc32(w) for w in single}, {tuple(p.split(b" ")): crc32(p) % buckets for p in pairs})


def bucket_lookups(lists, head: Head, longest: int, buckets: int):
    """The distinct words of some texts and their buckets, and the same for pairs."""
    states = {w: head.states[w] if w in head.states else crc32(w) for w in set().union(*lists)}
    single = {w: s % buckets for w, s in states.items()}
    pairs = {}
    if longest > 1:
        for pair in set().union(*(zip(x, x[1:]) for x in lists)):
            at = head.pairs.get(pair)
            pairs[pair] = crc32(b" " + pair[1], states[pair[0]]) % buckets if at is None else at
    return single, pairs


def _chunks(column):
    """(first row, word lists) of about CHUNK bytes of text each; nulls have no words."""
    held, size, first = [], 0, 0
    texts = column.cast(pa.large_binary())
    for i, text in enumerate(texts):
        raw = text.as_py() or b""
        if held and size + len(raw) > CHUNK:
            yield first, held
            held, size, first = [], 0, i
        held.append(words(raw))
        size += len(raw)
    if held:
        yield first, held


def _frequent(batches, head, longest):
    """The features that a task finds most often; rare ones are dropped on the way if there are
    very many. Which features make the head is no part of any result."""
    counts = Counter()
    for batch in batches:
        for _, lists in _chunks(batch.column(0)):
            for x in lists:
                counts.update(x)
                if longest > 1:
                    counts.update(zip(x, x[1:]))
            if len(counts) > 16 * head:
                counts = Counter(dict(counts.most_common(8 * head)))
    rows = [(b" ".join(f) if isinstance(f, tuple) else f, n) for f, n in counts.most_common(2 * head * longest)]
    rows = [(f, n) for f, n in rows if len(f) <= HEAD_BYTES]
    yield pa.RecordBatch.from_arrays([pa.array([f for f, _ in rows], pa.binary()), pa.array([n for _, n in rows], pa.int64())], ["feature", "n"])


def head_vocabulary(docs: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS, head: int = HEAD) -> Head:
    """The ``head`` most frequent words (and as many pairs, if pairs are features) of all texts."""
    found = docs.select("text").mapInArrow(lambda b: _frequent(b, head, longest), "feature binary, n long")
    pair = F.instr(F.col("feature").cast("string"), " ") > 0
    sums = written(found.groupBy("feature").agg(F.sum("n").alias("n")), "frequent")
    kinds = [sums.where(~pair), sums.where(pair)][:longest]
    return Head.of([bytes(r["feature"]) for k in kinds for r in k.orderBy(F.desc("n"), "feature").limit(head).collect()], buckets)


def bucket_totals(docs: DataFrame, head: Head, longest: int = LONGEST, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall into each bucket, exactly."""
    shared = docs.sparkSession.sparkContext.broadcast(head)

    def totals(batches):
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, lists in _chunks(batch.column(0)):
                single, pairs = bucket_lookups(lists, shared.value, longest, buckets)
                for x in lists:
                    counts += np.bincount(np.fromiter(map(single.__getitem__, x), np.int64, len(x)), minlength=buckets)
                    if longest > 1 and len(x) > 1:
                        counts += np.bincount(np.fromiter(map(pairs.__getitem__, zip(x, x[1:])), np.int64, len(x) - 1), minlength=buckets)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(counts[some])], ["bucket", "n"])

    rows = docs.select("text").mapInArrow(totals, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(buckets, np.int64)
    for r in rows:
        out[r["bucket"]] = r["n"]
    shared.destroy()
    return out


def gains(source: np.ndarray, target: np.ndarray) -> list[int]:
    """floor(1000 ln of the ratio of the smoothed shares) of each bucket."""
    n, all_source, all_target = len(source), float(source.sum()), float(target.sum())
    return [
        math.floor(1000 * math.log((t + 1.0) * (all_source + n) / ((s + 1.0) * (all_target + n))))
        for s, t in zip(source.tolist(), target.tolist(), strict=True)
    ]


def weights(docs: DataFrame, head: Head, gain: list[int], longest: int = LONGEST) -> DataFrame:
    """doc_id, n_words, n_features, weight of each row of ``docs``."""
    buckets = len(gain)
    shared = docs.sparkSession.sparkContext.broadcast((head, gain))
    names = ["doc_id", "n_words", "n_features", "weight"]

    def weighed(batches):
        for batch in batches:
            ids = batch.column(0)
            for first, lists in _chunks(batch.column(1)):
                single, pairs = bucket_lookups(lists, shared.value[0], longest, buckets)
                gain = shared.value[1]
                single = {w: gain[b] for w, b in single.items()}
                pairs = {p: gain[b] for p, b in pairs.items()}
                total = [sum(map(single.__getitem__, x)) for x in lists]
                if longest > 1:
                    total = [t + sum(map(pairs.__getitem__, zip(x, x[1:]))) for t, x in zip(total, lists, strict=True)]
                count = [len(x) for x in lists]
                features = [2 * n - 1 if longest > 1 and n else n for n in count]
                columns = [ids[first : first + len(lists)]] + [pa.array(c, pa.int64()) for c in (count, features, total)]
                yield pa.RecordBatch.from_arrays(columns, names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(weighed, "doc_id long, n_words long, n_features long, weight long")


def with_scores(weighed: DataFrame, seed: int = SEED) -> DataFrame:
    """Adds ``score``: the weight and Gumbel noise from a hash of seed and doc_id, in thousandths."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("doc_id").cast("string")).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0)))
    return weighed.withColumn("score", F.col("weight") + noise)


def resampled(
    docs: DataFrame, target: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS, least_words: int = LEAST_WORDS,
    share: int = SHARE, seed: int = SEED, head: int = HEAD,
) -> DataFrame:
    """Draw ``share`` percent of ``docs`` (doc_id, text) that are like ``target`` (text).

    Features are runs of 1 to ``longest`` words (1 or 2). Returns per row of ``docs`` doc_id,
    n_features, weight, score and rank: 1, 2, ... by falling score, ties by the smaller doc_id,
    null for rows that are not drawn. Ranks come from counts of range partitions, so no task
    sorts all rows.

    Null and empty texts have no features, weight 0 and are never drawn. Very long texts are
    weighed whole. Rows without a doc_id count in the totals; they have no score and are not
    drawn. Repeated rows are documents of their own, with the same score and ranks that follow
    one another. With an empty target all its totals are 0; empty ``docs`` give an empty
    result. Other columns are ignored.
    """
    if longest not in (1, 2):
        raise ValueError("features are runs of 1 or of 1 and 2 words")
    ship(docs.sparkSession)
    frequent = head_vocabulary(docs, longest, buckets, head)
    gain = gains(bucket_totals(docs, frequent, longest, buckets), bucket_totals(target, frequent, longest, buckets))
    scored = written(with_scores(weights(docs, frequent, gain, longest), seed), "scored")
    able = F.coalesce((F.col("n_words") >= least_words) & F.col("doc_id").isNotNull(), F.lit(False))
    drawn = share * scored.where(able).count() // 100
    columns = ["doc_id", "n_features", "weight", "score"]
    ranked = numbered(scored.where(able).select(*columns), [F.desc("score"), F.asc("doc_id")], "rank")
    rank = F.when(F.col("rank") <= drawn, F.col("rank"))
    rest = scored.where(~able).select(*columns, F.lit(None).cast("long").alias("rank"))
    return ranked.select(*columns, rank.cast("long").alias("rank")).unionByName(rest)


ORACLE = r"""
WITH crc AS (
  SELECT list_transform(range(256), lambda b: list_reduce(list_concat([b], range(8)),
    lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)) AS steps
), d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents
), b AS (
  SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM benchmark
), f AS (SELECT doc_id, unnest(words) AS word FROM d),
vocabulary AS (SELECT word FROM f UNION SELECT word FROM b),
hashed AS (
  SELECT word, hex(encode(word)) AS digits FROM vocabulary
), buckets AS (
  SELECT word, xor(list_reduce(list_concat([4294967295], list_transform(range(len(digits) // 2),
      lambda i: ('0x' || substr(digits, 2 * i + 1, 2))::BIGINT)),
    lambda x, v: xor(x // 256, steps[1 + xor(x, v) % 256])), 4294967295) % 10000 AS bucket
  FROM hashed, crc
), source AS (SELECT bucket, count(*) AS n FROM f JOIN buckets USING (word) GROUP BY bucket),
target AS (SELECT bucket, count(*) AS n FROM b JOIN buckets USING (word) GROUP BY bucket),
gain AS (
  SELECT word, CAST(floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT sum(n) FROM source) + 10000)::DOUBLE
    / ((coalesce(s.n, 0) + 1)::DOUBLE * (coalesce((SELECT sum(n) FROM target), 0) + 10000)::DOUBLE))) AS BIGINT) AS gain
  FROM buckets LEFT JOIN source s USING (bucket) LEFT JOIN target t USING (bucket)
), weight AS (SELECT doc_id, sum(gain)::BIGINT AS weight FROM f JOIN gain USING (word) GROUP BY doc_id),
scored AS (
  SELECT doc_id, len(words) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
  FROM d LEFT JOIN weight USING (doc_id)
), ranked AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM scored WHERE n_features >= 20
)
SELECT doc_id, n_features, weight, score,
  CASE WHEN rank <= (SELECT 10 * count(*) // 100 FROM ranked) THEN rank END AS rank
FROM scored LEFT JOIN ranked USING (doc_id)
"""
