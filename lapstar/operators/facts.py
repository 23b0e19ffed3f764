"""Fact rows from raw results and dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapstar.functions.columns import as_int, distance, parse_time, stroke
from lapstar.operators.dims import swimmer_columns
from lapstar.operators.joins import join_null_safe
from lapstar.operators.keys import number_rows
from lapstar.operators.quality import duplicates
from lapstar.operators.scd2 import current
from lapstar.schemas import FACT_PERFORMANCE, FACT_RANKINGS, SOURCE, SWIMMER_ATTRIBUTES, tie_columns
from lapstar.session import save


def numbered_swims(raw: DataFrame, tie: list[str] | None = None, attributes: bool = True) -> DataFrame:
    """The swims that have a swimmer, an event and a competition, numbered from 1 on, written.

    Numbers follow competition, event, place and swimmer. ``tie`` names raw columns that settle what is left; by
    default these are the source columns of ``read_results``, which spread even exact copies over tasks. Time and age
    come last. The rows are narrow and not joined yet, so that the range partitioning samples little: what the event tells
    is added afterwards, and the swimmer's ``attributes`` are left out where swims are matched by id alone.
    """
    tie = tie_columns(raw, tie)
    swims = raw.select(
        *(swimmer_columns() if attributes else swimmer_columns()[:1]),
        F.col("Competition_Competition_Id").alias("competition_id"),
        F.col("Event").alias("event"),
        parse_time("Time").alias("time_seconds"),
        as_int("Overall_Rank").alias("overall_rank"),
        as_int("Age").alias("age"),
        *tie,
        *([SOURCE[0]] if SOURCE[0] in raw.columns and SOURCE[0] not in tie else []),
    ).dropna(subset=["swimmer_id", "competition_id"])
    swims = swims.filter(distance("event").isNotNull())  # so there is an event, whose stroke is not null
    order = ["competition_id", "event", F.col("overall_rank").asc_nulls_last(), "swimmer_id"]
    only_order = [c for c in tie if c != SOURCE[0]]
    numbered = number_rows(swims, [*order, *tie, "time_seconds", "age"], "performance_id", drop=only_order)
    # The distinct events are parsed, not those of all swims: they are few, so that Spark broadcasts them.
    meaning = {"distance": distance("event"), "stroke": stroke("event")}
    return numbered.join(save(numbered.select("event").distinct().withColumns(meaning), "meanings"), "event").drop("event")


def performance(
    raw: DataFrame,
    swimmers: DataFrame,
    events: DataFrame,
    competitions: DataFrame,
    tie: list[str] | None = None,
    shared_ids: bool | None = None,
) -> DataFrame:
    """One row per swim, for the current version of the swimmer; ids from 1 on."""
    if shared_ids is None:
        shared_ids = has_shared_ids(swimmers)
    rows = resolved(numbered_swims(raw, tie, shared_ids), swimmers, events, competitions, shared_ids)
    return rows.select(*FACT_PERFORMANCE.names)


def has_shared_ids(swimmers: DataFrame) -> bool:
    """Whether an id has several current rows."""
    return not duplicates(current(swimmers), ["swimmer_id"], allow_null=True).isEmpty()


def resolved(
    swims: DataFrame,
    swimmers: DataFrame,
    events: DataFrame,
    competitions: DataFrame,
    shared_ids: bool | None = None,
) -> DataFrame:
    """Fact rows of ``numbered_swims`` for the current versions of ``swimmers``.

    Should an id have several current rows, the swim belongs to the one with its own name, birth date, gender
    and nationality; so a swim never becomes several rows, also when many swimmers share one id. Whether there
    are such ids is looked up in the dimension unless ``shared_ids`` tells.
    No side is hinted: Spark broadcasts dimensions below its threshold, and else AQE splits hot keys.
    """
    if shared_ids is None:
        shared_ids = has_shared_ids(swimmers)
    held = current(swimmers).filter(F.col("swimmer_id").isNotNull())
    return of_versions(swims, held, events, competitions, shared_ids)


def of_versions(
    swims: DataFrame, held: DataFrame, events: DataFrame, competitions: DataFrame, by_attributes: bool
) -> DataFrame:
    """Fact rows of ``numbered_swims`` for the given rows of the swimmers, matched by id or by all attributes; with the
    file they come from, where the swims have it."""
    joined = swims.join(events.select("event_sk", "distance", "stroke"), ["distance", "stroke"]).join(
        competitions.select("competition_sk", "competition_id"), "competition_id"
    )
    if by_attributes:
        match = ["swimmer_id", *SWIMMER_ATTRIBUTES]
        joined = join_null_safe(joined, held.select("swimmer_sk", *match), match)
    else:
        joined = joined.join(held.select("swimmer_sk", "swimmer_id"), "swimmer_id")
    return joined.select(*FACT_PERFORMANCE.names, *([SOURCE[0]] if SOURCE[0] in joined.columns else []))


def best_results(performance: DataFrame) -> DataFrame:
    """Best time and best place per swimmer and event; the two may come from different swims."""
    return performance.groupBy("swimmer_sk", "event_sk").agg(
        F.min("time_seconds").alias("best_time"), F.min("overall_rank").alias("best_rank")
    )


PAIR = ["swimmer_sk", "event_sk"]


def rankings(performance: DataFrame) -> DataFrame:
    """Best time and place of every swimmer and event, with ids from 1 on."""
    return number_rows(best_results(performance), PAIR, "ranking_id").select(*FACT_RANKINGS.names)


def with_ids(best: DataFrame, ids: DataFrame) -> DataFrame:
    """``best_results`` with the ``ranking_id`` that ``ids`` has for its pairs, or null, written: one join tells both which
    pairs are known and which are new."""
    return save(best.join(ids.select(*PAIR, "ranking_id"), PAIR, "left"), "best-results")


def new_rankings(found: DataFrame, start: int) -> DataFrame:
    """Ranking rows of the pairs that have no id in ``with_ids``, with the ids that follow ``start``."""
    fresh = found.filter("ranking_id IS NULL").drop("ranking_id")
    return number_rows(fresh, PAIR, "ranking_id", start).select(*FACT_RANKINGS.names)


def known_rankings(found: DataFrame) -> DataFrame:
    """Ranking rows of the other pairs."""
    return found.filter("ranking_id IS NOT NULL").select(*FACT_RANKINGS.names)


def load_rankings(best: DataFrame, ids: DataFrame) -> DataFrame:
    """One load's ranking rows: its own minima, whatever other loads have, so that each can be replaced alone."""
    return best.join(ids, PAIR).select(*FACT_RANKINGS.names)


def merge_rankings(stored: DataFrame) -> DataFrame:
    """One row per swimmer and event from the rows of all loads: minima merge."""
    return stored.groupBy("swimmer_sk", "event_sk").agg(
        F.min("ranking_id").alias("ranking_id"),
        F.min("best_time").alias("best_time"),
        F.min("best_rank").alias("best_rank"),
    )
