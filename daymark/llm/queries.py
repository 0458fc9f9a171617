"""The operators applied to their whole tables with production parameters."""

from __future__ import annotations

from functools import wraps

from . import (
    containment,
    disclosure,
    mixing,
    ngram_join,
    resampling,
    rp_forest,
    site_quality,
    suffix_levels,
    tag_paths,
    token_ids,
    toxicity,
    warc,
    whitening,
)
from .store import ship

QUERIES: dict = {}
ORACLES: dict = {
    "op6_containment": containment.ORACLE,
    "op11_revisits": warc.ORACLE,
    "op12_resampling": resampling.ORACLE,
}


def tokenizer_path() -> str:
    """The public tokenizer's file; only the driver reads it."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def query(f):
    """Register a query; the package goes to the executors before it runs."""

    @wraps(f)
    def run(spark, sf_dir):
        ship(spark)
        return f(spark, sf_dir)

    QUERIES[f.__name__] = run
    return run


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_rp_forest(spark, sf_dir):
    return rp_forest.nearest(table(spark, sf_dir, "embeddings"))


@query
def op2_site_quality(spark, sf_dir):
    return site_quality.site_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op3_ngram_jaccard(spark, sf_dir):
    return ngram_join.ngram_components(table(spark, sf_dir, "documents"))


@query
def op4_mixing(spark, sf_dir):
    return mixing.mixture_rates(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op5_suffix_levels(spark, sf_dir):
    return suffix_levels.without_repeats(table(spark, sf_dir, "documents"))


@query
def op6_containment(spark, sf_dir):
    return containment.contained(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op7_toxicity(spark, sf_dir):
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op8_tag_paths(spark, sf_dir):
    return tag_paths.main_text(table(spark, sf_dir, "pages"))


@query
def op9_token_ids(spark, sf_dir):
    return token_ids.token_ids(table(spark, sf_dir, "documents"), tokenizer_path())


@query
def op10_disclosure(spark, sf_dir):
    return disclosure.personal_data(table(spark, sf_dir, "documents"))


@query
def op11_revisits(spark, sf_dir):
    return warc.deduplicated(table(spark, sf_dir, "pages"))


@query
def op12_resampling(spark, sf_dir):
    return resampling.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op13_whitening(spark, sf_dir):
    return whitening.whitened(table(spark, sf_dir, "embeddings"))
