"""Dimension rows from raw results."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapstar.functions.columns import as_date, distance, gender_code, stroke
from lapstar.operators import scd2
from lapstar.operators.joins import join_null_safe
from lapstar.operators.keys import highest, number_rows
from lapstar.schemas import COURSE, DIM_COMPETITION, DIM_EVENT, DIM_SWIMMER, SWIMMER_ATTRIBUTES
from lapstar.session import empty, save


def swimmer_columns() -> list[Column]:
    return [
        F.col("SwimmerId").alias("swimmer_id"),
        F.col("Name").alias("name"),
        as_date("Birth_Date").alias("birth_date"),
        gender_code("Gender").alias("gender"),
        F.col("Citizenship").alias("nationality"),
    ]


def project_swimmers(raw: DataFrame) -> DataFrame:
    return raw.select(*swimmer_columns()).distinct()


def swimmer_feed(raw: DataFrame) -> DataFrame:
    """The distinct swimmers of the results, written: a merge reads them several times."""
    return save(project_swimmers(raw), "swimmers")


def programme(raw: DataFrame) -> DataFrame:
    """The distinct events of each competition, written: all that the two small dimensions need."""
    columns = ["Event", "Competition_Competition_Id", "Competition_Date", "Competition_Country", "Competition_Level"]
    return save(raw.select(*columns).distinct(), "programme")


def project_events(raw: DataFrame) -> DataFrame:
    return raw.select(
        distance("Event").alias("distance"), stroke("Event").alias("stroke"), F.lit(COURSE).alias("course")
    ).distinct()


def project_competitions(raw: DataFrame) -> DataFrame:
    """One row per competition id. Should its attributes differ, the greatest date, then text, is kept."""
    attributes = F.struct(
        as_date("Competition_Date").alias("competition_date"),
        F.col("Competition_Country").alias("location_code"),
        F.col("Competition_Level").alias("competition_name"),
    )
    return (
        raw.groupBy(F.col("Competition_Competition_Id").alias("competition_id"))
        .agg(F.max(attributes).alias("_attributes"))
        .select("competition_id", "_attributes.*")
    )


@dataclass(frozen=True)
class Change:
    """What a feed does to a dimension: ``kept`` rows, some of them altered if ``rewrites``, and ``added`` ones.

    When nothing known is altered, the added rows can be appended and the table need not be written again. Nor need it
    where the altered rows are given by themselves: ``closed`` has them as they are afterwards.
    """

    kept: DataFrame
    added: DataFrame
    rewrites: bool
    closed: DataFrame | None = None

    def whole(self) -> DataFrame:
        return self.kept.unionByName(self.added)


def swimmers(feed: DataFrame, as_of: dt.date | str | None = None, existing: DataFrame | None = None) -> Change:
    """Type 2 history of the rows of ``swimmer_feed``. Rows keep their keys, new versions get the next ones."""
    existing = existing if existing is not None else empty(feed.sparkSession, DIM_SWIMMER)
    key = "swimmer_id"
    touched = save(scd2.of_keys(existing, feed, key), "touched")
    new = scd2.new_versions(touched, feed, key, SWIMMER_ATTRIBUTES, as_of)
    order = [key, "valid_from", *SWIMMER_ATTRIBUTES]
    numbered = number_rows(new.drop("swimmer_sk"), order, "swimmer_sk", highest(existing, "swimmer_sk"))
    closed = save(scd2.closed(touched, feed, key, SWIMMER_ATTRIBUTES, as_of), "closed")
    old = scd2.kept(existing, feed, key, SWIMMER_ATTRIBUTES, as_of)
    return Change(old, numbered.select(*DIM_SWIMMER.names), not closed.isEmpty(), closed)


def unknown_swimmers(feed: DataFrame, existing: DataFrame) -> DataFrame:
    """The rows of a feed whose ids the dimension does not have at all."""
    return join_null_safe(feed, existing.select("swimmer_id"), ["swimmer_id"], "left_anti")


def versions_of(feed: DataFrame, existing: DataFrame) -> DataFrame:
    """For each row of a feed its own version in the dimension, the last if several are equal, or else the current one."""
    match = ["swimmer_id", *SWIMMER_ATTRIBUTES]
    own = existing.groupBy(*match).agg(F.max("swimmer_sk").alias("_own"))
    now = scd2.current(existing).groupBy("swimmer_id").agg(F.min("swimmer_sk").alias("_now"))
    found = join_null_safe(feed.select(*match), own, match, "left").join(now, "swimmer_id", "left")
    return found.select(*match, F.coalesce("_own", "_now").alias("swimmer_sk")).filter("swimmer_sk IS NOT NULL")


def events(raw: DataFrame, existing: DataFrame | None = None) -> Change:
    existing = existing if existing is not None else empty(raw.sparkSession, DIM_EVENT)
    missing = join_null_safe(project_events(raw), existing, ["distance", "stroke"], "left_anti")
    numbered = number_rows(missing, ["distance", "stroke"], "event_sk", highest(existing, "event_sk"))
    return Change(existing, numbered.select(*DIM_EVENT.names), False)


def competitions(raw: DataFrame, existing: DataFrame | None = None, update: bool = True) -> Change:
    """Known ids keep their keys and, with ``update``, take the attributes of the new results."""
    existing = existing if existing is not None else empty(raw.sparkSession, DIM_COMPETITION)
    found = save(project_competitions(raw), "competitions")
    key, attributes = ["competition_id"], ["competition_date", "location_code", "competition_name"]
    missing = join_null_safe(found, existing, key, "left_anti")
    start = highest(existing, "competition_sk")
    numbered = number_rows(missing, [*key, *attributes], "competition_sk", start)
    if not update:
        return Change(existing, numbered.select(*DIM_COMPETITION.names), False)
    known = join_null_safe(found, existing.select("competition_sk", *key), key).select(*DIM_COMPETITION.names)
    kept = join_null_safe(existing, found, key, "left_anti").unionByName(known)
    differs = not join_null_safe(known, existing, [*key, *attributes], "left_anti").isEmpty()
    return Change(kept, numbered.select(*DIM_COMPETITION.names), differs)
