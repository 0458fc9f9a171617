"""A training-data pipeline over ``documents``: five stages, each over all that the one before kept.

1. toxicity: documents that the classifier predicts toxic go.
2. n-gram Jaccard join: of each component one document stays, the one with the least doc_id.
3. benchmark decontamination: documents that contain a test item go.
4. mixing: documents are drawn at rates that bring the domains' tokens to the target weights.
5. token ids: the kept texts are encoded, written as Simple-8b segments and read back.

Stages 1 to 4 return the columns of ``documents``, stage 5 a row per document with its place in
the files. Every stage takes null texts and ids, repeated rows and empty tables as its operator
states. Rows without a doc_id pass stages 2 and 3 and end at stage 5, which orders by doc_id.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from daymark.llm import containment, mixing, ngram_join, token_ids, toxicity
from daymark.llm.queries import table, tokenizer_path
from daymark.llm.store import ship, written

#: As many tokens as the cleaned documents have, at the mixture's own targets.
MIX, MIX_BUDGET = mixing.TARGETS, 1.0

ORACLE_SQL = None


def clean(spark, docs, sf_dir):
    ship(spark)
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def one_of_each(spark, docs, sf_dir):
    ship(spark)
    groups = ngram_join.ngram_components(docs)
    first = groups.where("doc_id = component_id").select("doc_id").distinct()
    kept = docs.where("doc_id IS NOT NULL").join(first, "doc_id", "left_semi")
    # Repeated rows of the document that stays are copies as well; texts that differ are not.
    once = Window.partitionBy("doc_id", F.xxhash64("text")).orderBy(F.xxhash64(*docs.columns))
    kept = kept.withColumn("its row", F.row_number().over(once)).where("`its row` = 1")
    return kept.select(docs.columns).union(docs.where("doc_id IS NULL"))


def untested(spark, docs, sf_dir):
    ship(spark)
    return containment.without_items(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark, docs, sf_dir):
    ship(spark)
    return mixing.mixed(docs, table(spark, sf_dir, "labels"), MIX, MIX_BUDGET)


def encoded(spark, docs, sf_dir):
    ship(spark)
    return token_ids.token_ids(docs, tokenizer_path())


STAGES = [
    ("toxicity", clean),
    ("ngram_jaccard", one_of_each),
    ("decontamination", untested),
    ("mixing", mixed),
    ("token_ids", encoded),
]


def run(spark, sf_dir):
    """All stages in order over ``documents``; each reads what the one before wrote."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
