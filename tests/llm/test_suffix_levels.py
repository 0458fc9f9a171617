import hashlib

import pytest
from cases import awkward, documents, prose

from daymark.llm.suffix_levels import SuffixLevels, without_repeats


def brute(texts, length):
    """Per text: bytes, removed, spans and the hash of the rest, by looking at every window."""
    data = [(t or "").encode() for t in texts]
    seen = {}
    for b in data:
        for i in range(len(b) - length + 1):
            seen[b[i : i + length]] = seen.get(b[i : i + length], 0) + 1
    out = []
    for b in data:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        spans = sum(1 for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1]))
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        out.append((len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def cases():
    passage, other = prose(1, 40), prose(2, 30)
    return [
        passage, prose(3, 20) + passage + prose(4, 10), prose(5, 5) + passage[20:] + other, other[:150] + "é" * 90,
        "ab" * 150, "x" * 400, other + other, None, "", "short", prose(6, 60), prose(6, 60), passage[:120],
    ]


@pytest.mark.parametrize("length,seed,crowd,batches", [(60, 16, 1000, 2), (60, 60, 1, 3), (200, 32, 1000, 1)])
def test_equals_all_windows(spark, length, seed, crowd, batches):
    texts = cases()
    rows = without_repeats(documents(spark, texts), length, seed, batches, crowd).collect()
    got = {r["doc_id"]: tuple(r)[1:] for r in rows}
    assert [got[i] for i in range(len(texts))] == brute(texts, length)


def test_awkward_rows(spark):
    df = awkward(spark)
    source = [(r["doc_id"], r["text"]) for r in df.collect()]
    expected = sorted(zip([s[0] for s in source], brute([s[1] for s in source], 200), strict=True), key=str)
    got = sorted(((r["doc_id"], tuple(r)[1:]) for r in without_repeats(df).collect()), key=str)
    assert got == expected


def test_empty_table(spark):
    assert without_repeats(documents(spark, [])).collect() == []


def test_levels_merge_like_a_counter(spark):
    index = SuffixLevels(40, 8)
    ranks = []
    for b in range(6):
        index.add(documents(spark, [prose(b, 40), prose(b // 2, 40)]).select("text"))
        ranks.append([rank for rank, _ in index.levels])
    assert ranks == [[0], [1], [1, 0], [2], [2, 0], [2, 1]]


def test_pieces_of_a_row_above_the_place_limit(spark, monkeypatch):
    from daymark.llm import suffix_levels

    text = prose(8, 300)
    import numpy as np

    whole = suffix_levels._runs(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text)]), 50, 10)
    monkeypatch.setattr(suffix_levels, "PLACE_BITS", 9)
    import pyarrow as pa

    starts = []
    for _, _, data, edges, shift in suffix_levels._pieces(pa.array([text]), 50):
        first, run, *_ = suffix_levels._runs(data, edges, 50, 10)
        starts += [shift + s + k for s, n in zip(first, run, strict=True) for k in range(n)]
    assert starts == [s + k for s, n in zip(whole[0], whole[1], strict=True) for k in range(n)]
