import zlib

import numpy as np
import pytest
from cases import awkward, documents, prose
from hypothesis import given
from hypothesis import strategies as st

from daymark.llm import simple8b
from daymark.llm.queries import tokenizer_path
from daymark.llm.token_ids import END, read_ids, token_ids, write_ids

numbers = st.one_of(st.integers(0, 3), st.integers(0, 50_000), st.integers(0, 2**64 - 1), st.just(0))


@given(st.lists(numbers, max_size=700), st.sampled_from([1, 7, 128, 256]))
def test_round_trip(values, block):
    data = np.array(values, np.uint64)
    words, offsets = simple8b.encode(data, block)
    assert simple8b.decode(words, offsets, len(data), block).tolist() == values


@pytest.mark.parametrize("value", [0, 1, 2**7, 2**15 - 1, 2**20, 2**60 - 1, 2**60, 2**64 - 1])
def test_runs_of_one_value(value):
    data = np.full(1000, value, np.uint64)
    words, offsets = simple8b.encode(data)
    assert (simple8b.decode(words, offsets, 1000) == data).all()


def test_words_hold_as_many_values_as_fit():
    words, _ = simple8b.encode(np.full(240, 20_000, np.uint64), 240)
    assert len(words) == 60
    assert len(simple8b.encode(np.zeros(240, np.uint64), 240)[0]) == 2


def test_segments_name_their_documents():
    data = simple8b.segment(np.array([-5, 2**40]), np.array([3, 0]), np.array([7, 8, 9], np.uint64))
    ids, counts, values = simple8b.read_segment(data)
    assert (ids.tolist(), counts.tolist(), values.tolist()) == ([-5, 2**40], [3, 0], [7, 8, 9])
    for broken in (b"", b"XXXX" + data[4:], data[:-1]):
        with pytest.raises(ValueError):
            simple8b.read_segment(broken)


def expected(rows):
    from tokenizers import Tokenizer

    tokenizer, at, out = Tokenizer.from_file(tokenizer_path()), 0, []
    for i, text in sorted(rows):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, END]
        out.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
        at += len(ids)
    return out


TEXTS = [
    prose(1, 300), "", None, "Don't  STOP me now \u0085 x\u001cy", "ΑΣ ΣΑΣ. ὈΔΥΣΣΕΎΣ", "é ́a Å ﬁ İ ẞ",
    "<|endoftext|> a<|startoftext|>b <|endoftext|", "12345 3.14 +-*/ ###!!! 日本語テキスト 👩‍👩‍👧", "a" * 3000, "\t\n \x0b\x0c\r", "　x　",
]


def test_ids_are_those_of_whole_texts(spark, tmp_path):
    rows = token_ids(documents(spark, TEXTS), tokenizer_path(), segment_ids=200, listed=True).collect()
    assert sorted(tuple(r) for r in rows) == expected(list(enumerate(TEXTS)))


def test_files_are_in_ascending_order(spark, tmp_path):
    path = str(tmp_path / "ids")
    docs = documents(spark, [prose(i, 50) for i in range(100)]).repartition(7)
    write_ids(docs, path, tokenizer_path(), 300)
    stored = sorted(spark.read.parquet(path).collect(), key=lambda r: (r["part"], r["seq"]))
    ids = [i for r in stored for i in simple8b.read_segment(r["data"])[0].tolist()]
    assert ids == list(range(100)) and len(stored) > 10
    starts = [r["start"] for r in sorted(read_ids(spark, path).collect())]
    assert starts == sorted(starts) and starts[0] == 0


def test_awkward_rows(spark):
    df = awkward(spark)
    rows = sorted(tuple(r) for r in token_ids(df, tokenizer_path()).collect())
    assert rows == [r[:4] for r in expected([(r["doc_id"], r["text"]) for r in df.collect() if r["doc_id"] is not None])]


def test_empty_table(spark):
    assert token_ids(documents(spark, []), tokenizer_path()).collect() == []


def test_words_by_stretches_equal_whole_texts():
    """Every letter of the fast class, marks behind words, and what looks like them."""
    import random

    import pyarrow as pa
    from tokenizers import Tokenizer

    from daymark.llm import token_ids as module

    r, definition = random.Random(3), open(tokenizer_path()).read()
    whole, fast = Tokenizer.from_str(definition), module.WordTokenizer(definition)
    letters = [chr(c) for c in range(0x41, 0x180) if chr(c).isalpha()]
    marks = [chr(c) for c in range(0x21, 0x7F) if not chr(c).isalnum()]
    odd = ["́", "̱", " ", "​", "İ", "ŉ", "ẖ", "ﬁ", "Σ", "5", "'s", "'LL", "<|endoftext|>", "日", "👩", "ẞ"]
    texts = ["".join(letters), " ".join(letters), " ".join(marks), "".join(marks), "H̱ ẖ <|ENDOFTEXT|> a<|endoftext|>.", "", None]
    for _ in range(400):
        words = []
        for _ in range(r.randint(1, 30)):
            word = "".join(r.choices(letters, k=r.randint(0, 6))) + "".join(r.choices(marks, k=r.choice([0, 0, 1, 3])))
            words.append(word + (r.choice(odd) + r.choice(letters) if r.random() < 0.15 else ""))
        texts.append(r.choice([" ", "\n", "  \t"]).join(words))
    for _ in range(2):  # without and with remembered words
        ids, counts = fast.ids(pa.array(texts))
        ends = np.cumsum(counts)
        for text, a, b in zip(texts, ends - counts, ends, strict=True):
            assert ids[a:b].tolist() == [*whole.encode(text or "", add_special_tokens=False).ids, END], text


def test_the_word_table_begins_anew_above_its_bound(monkeypatch):
    import pyarrow as pa

    from daymark.llm import token_ids as module

    monkeypatch.setattr(module, "REMEMBERED", 2_000)
    fast = module.WordTokenizer(open(tokenizer_path()).read())
    texts = [prose(k, 200) for k in range(30)]
    at_once = [module.WordTokenizer.ids(fast, pa.array([t]))[0].tolist() for t in texts]
    assert module._words[fast.name].nbytes < 30_000
    assert [i for t in at_once for i in t] == fast.ids(pa.array(texts))[0].tolist()
