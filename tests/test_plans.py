"""Physical plans: what reaches the scan, how much is shuffled, what is broadcast."""

import re
from pathlib import Path

import pytest

from daymark import plans

QUERIES = plans.queries()


def plan(spark, sf_dir, name):
    return QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()


def final_plan(spark, sf_dir, name):
    """The plan after adaptive execution has run it."""
    execution = QUERIES[name](spark, sf_dir)._jdf.queryExecution()
    execution.toRdd().count()
    return execution.executedPlan().toString().split("== Initial Plan ==")[0]


def shuffles(text):
    return len(re.findall(r"Exchange (?:hash|range|round)", text))


def test_day_filters_reach_the_scan(spark, sf_dir):
    text = plan(spark, sf_dir, "host_activity")
    assert "PushedFilters" in text
    assert "GreaterThanOrEqual(ts,2024-01-30T00:00)" in text
    assert "LessThan(ts,2024-01-31T00:00)" in text
    assert "props" not in text and "value" not in text


def test_only_needed_columns_are_read(spark, sf_dir):
    text = plan(spark, sf_dir, "top_avg_kills")
    schemas = set(re.findall(r"ReadSchema: struct<([^>]*)>", text))
    assert schemas == {
        "l_orderkey:bigint,l_suppkey:bigint,l_quantity:double",
        "o_orderkey:bigint,o_custkey:bigint",
        "c_custkey:bigint",
    }


def test_dedupe_limits_groups_before_the_shuffle(spark, sf_dir):
    text = plan(spark, sf_dir, "dedupe")
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")
    assert shuffles(text) == 1


@pytest.mark.parametrize("name", ["top_player_team", "rolling_wins_90", "top_map"])
def test_leaders_need_no_sort(spark, sf_dir, name):
    text = plan(spark, sf_dir, name)
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def test_bits_need_no_shuffle(spark):
    from pyspark.sql import functions as F

    from daymark.operators.activity import datelist_bits

    df = spark.range(3).select(F.array(F.current_date()).alias("days"))
    bits = datelist_bits(df, "days", F.current_date())
    assert "Exchange" not in bits._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name, expected",
    [
        # Rows by (team, cell), after meeting the hot keys by team, whose size is not known
        # beforehand; the game table needs one shuffle per side of its join.
        ("rolling_wins", 4),
        # The slots by (ip, host, slot), then the slots left by (ip, host).
        ("sessions", 2),
        # Orders by (customer, year), to the hot keys and back to their cells; parts; quiet
        # years by (customer, year) and by customer.
        ("entity_year_snapshot", 6),
    ],
)
def test_without_hot_keys_their_branches_vanish(spark, sf_dir, name, expected):
    setting = "spark.sql.autoBroadcastJoinThreshold"
    plain = spark.conf.get(setting)
    spark.conf.set(setting, -1)  # as if no table were small
    try:
        text = final_plan(spark, sf_dir, name)
    finally:
        spark.conf.set(setting, plain)
    # The rows may be on their way to the keys before the keys are known to be none: one more.
    assert expected <= shuffles(text) <= expected + 1
    assert "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"layout_report", "bucketed_join"}))
def test_no_query_pairs_all_rows(spark, sf_dir, name):
    if "stream" in name:
        pytest.skip("the result is read from the stream's tables")
    text = plan(spark, sf_dir, name)
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    assert "Python" not in text and "Pandas" not in text


def test_library_keeps_to_durable_lineage():
    root = Path(__file__).parent.parent / "daymark"
    for source in root.rglob("*.py"):
        text = source.read_text()
        assert "localCheckpoint" not in text and "toPandas" not in text, source
        if source.parent.name == "llm":
            continue  # collects tables whose size a parameter bounds, such as a model
        assert "localCheckpoint" not in text and ".collect()" not in text, source
        assert "toPandas" not in text and ".rdd" not in text, source
