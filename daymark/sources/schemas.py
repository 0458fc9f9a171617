"""Schemas of the tables the operators read and write."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from ..functions.conditions import QUALITY_FLOOR, QUALITY_THRESHOLDS

TEXT, INT, LONG, DOUBLE = StringType(), IntegerType(), LongType(), DoubleType()
FLAG, DAY, TIME = BooleanType(), DateType(), TimestampType()


def schema(**fields: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in fields.items()])


FILM = schema(film=TEXT, votes=INT, rating=DOUBLE, filmid=TEXT)

ACTOR_FILMS = schema(
    actor=TEXT, actorid=TEXT, film=TEXT, votes=INT, rating=DOUBLE, filmid=TEXT, year=INT
)
ACTORS = schema(
    actor=TEXT,
    actorid=TEXT,
    films=ArrayType(FILM),
    quality_class=TEXT,
    is_active=FLAG,
    this_year=INT,
)
ACTORS_HISTORY = schema(
    actor=TEXT, quality_class=TEXT, is_active=FLAG, start_date=INT, end_date=INT, this_year=INT
)
PLAYERS = schema(player_name=TEXT, season=INT, is_active=FLAG)
GAME_DETAILS = schema(
    game_id=LONG, team_id=LONG, team_abbreviation=TEXT, player_id=LONG, player_name=TEXT, pts=INT
)
GAMES = schema(
    game_id=LONG,
    season=INT,
    game_date_est=DAY,
    home_team_id=LONG,
    visitor_team_id=LONG,
    home_team_wins=INT,
)
WEB_EVENTS = schema(user_id=LONG, device_id=LONG, host=TEXT, event_time=TEXT)
DEVICES = schema(device_id=LONG, browser_type=TEXT)
USER_DEVICES = schema(
    user_id=TEXT, browser_type=TEXT, device_activity_date_list=ArrayType(DAY), date=DAY
)
HOSTS = schema(host=TEXT, host_activity_datelist=ArrayType(DAY), c_date=DAY)
HOST_MONTHS = schema(
    month_start=DAY, host=TEXT, hit_array=ArrayType(LONG), unique_visitors_array=ArrayType(LONG)
)
MATCH_DETAILS = schema(
    match_id=TEXT, player_gamertag=TEXT, player_total_kills=INT, player_total_deaths=INT
)
MATCHES = schema(
    match_id=TEXT, is_team_game=FLAG, playlist_id=TEXT, completion_date=TIME, map_id=TEXT
)
MATCH_MEDALS = schema(match_id=TEXT, medal_id=LONG, count=INT)
MEDALS = schema(medal_id=LONG, name=TEXT)
MAPS = schema(map_id=TEXT, name=TEXT)
STREAM_EVENTS = schema(window_timestamp=TIME, ip=TEXT, host=TEXT)
SESSIONS = schema(
    session_start=TIME, session_end=TIME, ip=TEXT, host=TEXT, events_in_session=LONG
)
METRIC_AVERAGES = schema(metric=TEXT, avg_events_per_session=DOUBLE)
HOST_AVERAGES = schema(host=TEXT, avg_events_per_session=DOUBLE)

# Primary keys, checked with operators.quality.key_violations.
KEYS = {
    "actors": ["actorid", "this_year"],
    "actors_history": ["actor", "start_date"],
    "user_devices": ["user_id", "browser_type", "date"],
    "hosts": ["host", "c_date"],
    "host_months": ["host", "month_start"],
}

# Allowed values of the quality class; Spark has no enumerated type.
QUALITY_CLASSES = [name for name, _ in QUALITY_THRESHOLDS] + [QUALITY_FLOOR]


def as_schema(df: DataFrame, wanted: StructType) -> DataFrame:
    """Columns of a schema in its order and types; a missing column is an error."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in wanted])
