import zlib

import pytest
from cases import awkward, component_of, documents, edited, prose

import corpus_pipeline
from daymark.llm.token_ids import END


@pytest.fixture()
def folder(spark, tmp_path):
    """Documents with toxic ones, near copies and test items, and the tables they are judged by."""
    texts = []
    for i in range(150):
        text = prose(i, 60)
        if i % 10 == 0:
            text += " horridword nastyphrase"
        if i % 10 in (1, 2) and i > 10:
            text = edited(prose(i - i % 10, 60), i, 1)
        if i % 10 == 3:
            text += " " + prose(9000 + i % 3, 30)
        texts.append(text)
    documents(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 10 == 0)) for i in range(150)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(i, prose(9000 + i, 30)) for i in range(3)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path), texts


def test_stages_take_effect(spark, folder):
    path, texts = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    ids = set(range(150))
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, path)
        if name != "token_ids":
            assert docs.columns == before.columns and docs.dtypes == before.dtypes
        got = {r["doc_id"] for r in docs.collect()}
        if name == "toxicity":
            ids -= {i for i in ids if i % 10 == 0}
        elif name == "ngram_jaccard":
            least = component_of([(i, texts[i]) for i in ids])
            ids = {i for i in ids if least[i] == i}
        elif name == "decontamination":
            ids -= {i for i in ids if i % 10 == 3}
        elif name == "mixing":
            assert got <= ids and len(got) > 0.8 * len(ids)
            ids = got
        assert got == ids


def test_the_mixture_gives_up_no_tokens():
    assert corpus_pipeline.MIX_BUDGET == 1 and corpus_pipeline.MIX == corpus_pipeline.mixing.TARGETS


def test_run_ends_with_the_ids_of_what_is_left(spark, folder):
    from tokenizers import Tokenizer

    from daymark.llm.queries import tokenizer_path

    path, texts = folder
    tokenizer = Tokenizer.from_file(tokenizer_path())
    at = 0
    for r in corpus_pipeline.run(spark, path).orderBy("start").collect():
        ids = [*tokenizer.encode(texts[r["doc_id"]], add_special_tokens=False).ids, END]
        raw = b"".join(i.to_bytes(4, "little") for i in ids)
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(raw))
        at += len(ids)


def test_awkward_rows_pass(spark, folder):
    path, _ = folder
    docs = awkward(spark)
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, docs, path)
        assert out.columns == docs.columns
        if name == "ngram_jaccard":
            kept = sorted((r["doc_id"] for r in out.collect()), key=str)
            assert kept == sorted([1, 4, 5, 6, 7, 9, 11, 12, None, None], key=str)
        if name == "toxicity":
            # Only document 10 is labelled toxic.
            assert {r["doc_id"] for r in out.collect()} >= {1, 2, 3, 4, 5, 6, 7, 8, 9, 11, 12, None}
        if name == "decontamination":
            assert out.count() == 15
    assert corpus_pipeline.STAGES[4][1](spark, docs, path).count() == 13


def test_empty_documents(spark, folder):
    path, _ = folder
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, documents(spark, []), path).collect() == []
