import hashlib
import math
import re
import zlib

import pytest
from cases import awkward, documents, prose

from daymark.llm import resampling
from daymark.llm.resampling import Head, bucket_totals, head_vocabulary, resampled

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text, longest):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    return words, [" ".join(words[i : i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1)]


def brute(rows, target, longest=1, buckets=10_000, least=20, share=10, seed=2024):
    source, wanted = [0] * buckets, [0] * buckets
    for texts, counts in ((rows, source), (target, wanted)):
        for _, text in texts:
            for f in features(text, longest)[1]:
                counts[zlib.crc32(f.encode()) % buckets] += 1
    big, small = sum(source), sum(wanted)
    gain = [math.floor(1000 * math.log((float(t + 1) * float(big + buckets)) / (float(s + 1) * float(small + buckets)))) for s, t in zip(source, wanted, strict=True)]
    out, able = [], []
    for i, text in rows:
        words, all_features = features(text, longest)
        weight = sum(gain[zlib.crc32(f.encode()) % buckets] for f in all_features)
        score = None
        if i is not None:
            h = int(hashlib.sha256(f"{seed}:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
            if len(words) >= least:
                able.append((-score, i, len(out)))
        out.append([i, len(all_features), weight, score, None])
    for rank, (_, _, at) in enumerate(sorted(able)[: share * len(able) // 100], 1):
        out[at][4] = rank
    return sorted(map(tuple, out), key=str)


def items(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")


TEXTS = [prose(k % 40, 15 + k) + (" Ünï-code 3.14 É" if k % 3 else " ") * (k % 5) for k in range(90)] + [None, "", "...", "ONE two"]
TARGET = [prose(k, 60) for k in range(5)] + [None, "É é"]


@pytest.mark.parametrize("longest", [1, 2])
@pytest.mark.parametrize("head", [1, 20, 1 << 15])
def test_equals_counting(spark, longest, head):
    rows = list(enumerate(TEXTS))
    df = resampled(documents(spark, rows).repartition(5), items(spark, TARGET), longest, 500, share=35, head=head)
    assert df.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted((tuple(r) for r in df.collect()), key=str) == brute(rows, list(enumerate(TARGET)), longest, 500, share=35)


def test_head_holds_the_frequent_features(spark):
    docs = documents(spark, ["the cat the dog the cat", "The cat", "x" * 100 + " the"])
    head = head_vocabulary(docs, 2, 100, 2)
    assert head.states == {b"the": zlib.crc32(b"the"), b"cat": zlib.crc32(b"cat")}
    assert head.pairs[b"the", b"cat"] == zlib.crc32(b"the cat") % 100 and len(head.pairs) == 2
    whole = bucket_totals(docs, head, 2, 100)
    assert (whole == bucket_totals(docs, Head({}, {}), 2, 100)).all() and whole.sum() == 10 + 7


def test_rare_features_that_are_dropped_on_the_way_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(resampling, "CHUNK", 100)
    rows = list(enumerate(TEXTS))
    got = resampled(documents(spark, rows), items(spark, TARGET), head=1).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows, list(enumerate(TARGET)))


def test_awkward_rows(spark):
    df = awkward(spark)
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    got = resampled(df, items(spark, TARGET), least_words=2, share=60).collect()
    # Repeated rows take ranks that follow one another.
    assert sorted((tuple(r) for r in got), key=str) == brute(rows, list(enumerate(TARGET)), least=2, share=60)


@pytest.mark.parametrize("texts,target", [([], TARGET), (TEXTS, []), ([], []), ([None], [None])])
def test_empty_tables(spark, texts, target):
    rows = list(enumerate(texts))
    got = resampled(documents(spark, rows), items(spark, target)).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows, list(enumerate(target)))


def test_longer_runs_are_refused(spark):
    with pytest.raises(ValueError):
        resampled(documents(spark, []), items(spark, []), longest=3)


def test_query_equals_its_sql(spark, sf_dir):
    from compare import connect, differences

    from daymark.llm.queries import ORACLES, QUERIES

    name = "op12_resampling"
    assert differences(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLES[name]) == ""
