"""Snapshots, type-2 dimensions and activity states."""

import random

import pytest
from pyspark.testing import assertDataFrameEqual

from daymark.operators.history import (
    accumulate_items,
    entity_period_snapshot,
    lowest_id_per_name,
    scd2_backfill,
    scd2_increment,
    scd2_increment_as_written,
    state_change_history,
    state_change_pair,
)

KEY, TRACKED = ["actor"], ["quality_class", "is_active"]


def credits(spark, rows):
    return spark.createDataFrame(
        rows, "actor string, actorid string, film string, rating double, filmid int, year int"
    )


def snapshot(facts, last=2002, **options):
    return entity_period_snapshot(
        facts, ["actorid"], "year", ["film", "rating"], "filmid", "rating", 1970, last, **options
    )


CREDITS = [
    ("Ann", "a1", "One", 9.0, 1, 2000),
    ("Ann", "a1", "Two", 7.5, 2, 2000),
    ("Ann", "a1", "Three", None, 3, 2002),
    ("Bob", "b1", "Four", 6.5, 4, 2001),
    ("Bob", "b2", "Five", 8.5, 5, 2001),
]


def test_snapshot(spark):
    rows = {(r.actorid, r.year): r for r in snapshot(credits(spark, CREDITS)).collect()}
    assert sorted(rows) == [
        ("a1", 2000), ("a1", 2001), ("a1", 2002),
        ("b1", 2001), ("b1", 2002), ("b2", 2001), ("b2", 2002),
    ]
    assert [i.film for i in rows["a1", 2000]["items"]] == ["One", "Two"]
    # The last film by id decides; a missing rating or a year without films is the floor.
    classes = {k: (r.quality_class, r.is_active, r.part) for k, r in rows.items()}
    assert classes["a1", 2000] == ("good", True, 0)
    assert classes["a1", 2001] == ("bad", False, 0)
    assert classes["a1", 2002] == ("bad", True, 0)
    assert classes["b1", 2001] == ("average", True, 0)
    assert classes["b2", 2001] == ("star", True, 0)
    assert rows["a1", 2001]["items"] == []


def test_homonyms_by_name_keep_the_lowest_id(spark):
    kept = lowest_id_per_name(credits(spark, CREDITS), "actor", "actorid")
    assert {r.actorid for r in kept.collect()} == {"a1", "b1"}


def test_items_of_a_large_group_are_spread_over_parts(spark):
    rows = [("Ann", "a1", f"f{n:03}", float(n % 10), n, 2000) for n in range(100)]
    facts = credits(spark, rows + CREDITS[3:])
    whole = {(r.actorid, r.year): r for r in snapshot(facts).collect()}
    for size, rows in ((20, 1000), (7, 10), (100, 3)):
        cut = snapshot(facts, part_items=size, max_rows=rows)
        parts = cut.where("actorid = 'a1' and year = 2000").collect()
        parts.sort(key=lambda r: r.part)
        assert [r.part for r in parts] == list(range(-(-100 // size)))
        assert {len(r["items"]) for r in parts[:-1]} <= {size}
        assert [i for r in parts for i in r["items"]] == whole["a1", 2000]["items"]
        assert {(r.quality_class, r.is_active) for r in parts} == {("star", True)}
        total = accumulate_items(cut, ["actorid"], "year").where("actorid = 'a1'").collect()
        assert {len(r["items"]) for r in total if r.year == 2000} == {100}
    others = snapshot(facts, part_items=20).where("actorid <> 'a1' or year <> 2000")
    assert {(r.actorid, r.year): r for r in others.collect()} == {
        k: r for k, r in whole.items() if k != ("a1", 2000)
    }


def test_accumulated_items(spark):
    rows = accumulate_items(snapshot(credits(spark, CREDITS)), ["actorid"], "year").collect()
    films = {(r.actorid, r.year): [i.film for i in r["items"]] for r in rows}
    assert films["a1", 2001] == ["One", "Two"]
    assert films["a1", 2002] == ["One", "Two", "Three"]


YEARLY = "actor string, this_year int, quality_class string, is_active boolean"


def random_years(spark, seed):
    rng = random.Random(seed)
    rows = []
    for n in range(30):
        for year in range(rng.randrange(2000, 2006), 2006):
            rows.append((f"a{n}", year, rng.choice("xy"), rng.random() < 0.7))
    return spark.createDataFrame(rows, YEARLY)


@pytest.mark.parametrize("seed", [1, 2])
def test_increments_equal_the_backfill(spark, seed):
    years = random_years(spark, seed).cache()
    history = scd2_backfill(years, KEY, "this_year", TRACKED, 2002)
    for year in (2003, 2004, 2005):
        current = years.where(f"this_year = {year}")
        history = scd2_increment(history, current, KEY, TRACKED, year - 1, "this_year")
        expected = scd2_backfill(years, KEY, "this_year", TRACKED, year)
        assertDataFrameEqual(history, expected, ignoreNullable=True)


def test_backfill_treats_null_as_a_value_and_does_not_open_on_the_first_row(spark):
    years = spark.createDataFrame(
        [("a", 2000, None, True), ("a", 2001, None, True), ("a", 2002, "x", True)], YEARLY
    )
    rows = scd2_backfill(years, KEY, "this_year", TRACKED, 2002).collect()
    assert sorted((r.start_date, r.end_date, r.quality_class) for r in rows) == [
        (2000, 2001, None),
        (2002, 2002, "x"),
    ]


HISTORY = (
    "actor string, quality_class string, is_active boolean, "
    "start_date int, end_date int, this_year int"
)


def increment_case(spark):
    history = spark.createDataFrame(
        [
            ("a", "x", True, 2000, 2000, 2003),
            ("a", "y", True, 2001, 2001, 2003),
            ("a", "x", True, 2002, 2003, 2003),
            ("gone", "x", True, 2000, 2003, 2003),
            ("same", "z", False, 2003, 2003, 2003),
        ],
        HISTORY,
    )
    current = spark.createDataFrame(
        [("a", 2004, "y", True), ("same", 2004, "z", False), ("new", 2004, "x", True)], YEARLY
    )
    return history, current


def test_increment_with_two_closed_rows_and_one_open(spark):
    rows = scd2_increment(*increment_case(spark), KEY, TRACKED, 2003, "this_year").collect()
    assert {r.this_year for r in rows} == {2004}
    assert sorted((r.actor, r.quality_class, r.start_date, r.end_date) for r in rows) == [
        ("a", "x", 2000, 2000),
        ("a", "x", 2002, 2003),
        ("a", "y", 2001, 2001),
        ("a", "y", 2004, 2004),
        ("gone", "x", 2000, 2003),
        ("new", "x", 2004, 2004),
        ("same", "z", 2003, 2004),
    ]


def test_increment_as_written_repeats_rows(spark):
    rows = scd2_increment_as_written(
        *increment_case(spark), KEY, TRACKED, 2003, "this_year"
    ).collect()
    counted = sorted((r.actor, r.quality_class, r.start_date, r.end_date) for r in rows)
    assert counted == sorted(
        [
            # every stored row
            ("a", "x", 2000, 2000), ("a", "y", 2001, 2001), ("a", "x", 2002, 2003),
            ("gone", "x", 2000, 2003), ("same", "z", 2003, 2003),
            # each differing stored row again, with a new row each
            ("a", "x", 2000, 2000), ("a", "y", 2004, 2004),
            ("a", "x", 2002, 2003), ("a", "y", 2004, 2004),
            # each equal stored row extended
            ("a", "y", 2001, 2004), ("same", "z", 2003, 2004),
            ("new", "x", 2004, 2004),
        ]
    )


def test_state_of_two_seasons(spark):
    schema = "player string, season int, is_active boolean"
    old = [("stay", True), ("stop", True), ("back", False), ("out", False), ("gone", True), ("null", None)]
    new = [("stay", True), ("stop", False), ("back", True), ("out", False), ("debut", False), ("null", True)]
    rows = state_change_pair(
        spark.createDataFrame([(p, 1996, a) for p, a in old], schema),
        spark.createDataFrame([(p, 1997, a) for p, a in new], schema),
        ["player"],
        "is_active",
        "season",
    ).collect()
    assert {r.season for r in rows} == {1997}
    assert {r.player: r.state_change for r in rows} == {
        "stay": "Continued Playing",
        "stop": "Retired",
        "back": "Returned From Retired",
        "out": "Stayed Retired",
        "debut": "New",
        "gone": "Unknown",
        "null": "Unknown",
    }
    gone = next(r for r in rows if r.player == "gone")
    assert (gone.was_active, gone.is_active_now, gone.previous_period) == (True, None, 1996)


def test_state_history_skips_gaps_and_leaves_an_inactive_debut_open(spark):
    df = spark.createDataFrame(
        [("a", 2000, True), ("a", 2004, True), ("b", 2000, False), ("b", 2001, True)],
        "player string, season int, is_active boolean",
    )
    rows = state_change_history(df, ["player"], "season", "is_active").collect()
    assert {(r.player, r.season): (r.state_change, r.previous_period) for r in rows} == {
        ("a", 2000): ("New", None),
        ("a", 2004): ("Continued Playing", 2000),
        ("b", 2000): (None, None),
        ("b", 2001): ("Returned From Retired", 2000),
    }
