"""The analytical reports.

Swims are aggregated on surrogate keys before they meet the swimmers. Reports that need only best times, or which
events were swum, read ``fact_rankings`` instead: the load keeps one row per swimmer and event there.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lapstar.functions.columns import age_group, age_years, cut_label
from lapstar.operators.scd2 import current
from lapstar.schemas import CLUB_PLACEHOLDER, Params, Warehouse

# The report's column per stroke.
STROKE_COUNTS = {
    "Butterfly": "butterfly_count",
    "Freestyle": "freestyle_count",
    "Backstroke": "back_count",
    "Breaststroke": "breast_count",
}


def _with_stroke(fact: DataFrame, warehouse: Warehouse) -> DataFrame:
    return fact.join(warehouse.events.select("event_sk", "stroke"), "event_sk")


def swimmer_rankings(warehouse: Warehouse) -> DataFrame:
    """How many of a swimmer's own swims rank 1 to 5 by time, per stroke.

    Equal times share a rank and leave a gap. Swims are first counted per time, so a rank is one more than the
    count of all faster times, and the five fastest times hold all of ranks 1 to 5.
    """
    swims = _with_stroke(warehouse.performance, warehouse)
    times = swims.groupBy("swimmer_sk", "stroke", "time_seconds").agg(F.count("*").alias("swims"))
    fastest = Window.partitionBy("swimmer_sk", "stroke").orderBy(F.col("time_seconds").asc_nulls_last())
    first = times.withColumn("nth", F.row_number().over(fastest)).filter("nth <= 5")
    faster = F.sum("swims").over(fastest.rowsBetween(Window.unboundedPreceding, -1))
    ranked = first.withColumn("rank", F.coalesce(faster, F.lit(0)) + 1)
    names = [f"rank_{k}_count" for k in range(1, 6)]
    counts = ranked.groupBy("swimmer_sk", "stroke").agg(
        *[F.sum(F.when(F.col("rank") == k, F.col("swims")).otherwise(0)).alias(n) for k, n in enumerate(names, 1)]
    )
    named = counts.join(warehouse.swimmers.select("swimmer_sk", "name"), "swimmer_sk")
    return named.groupBy(F.col("name").alias("swimmer_name"), "stroke").agg(*[F.sum(n).alias(n) for n in names])


def club_region_performance(warehouse: Warehouse) -> DataFrame:
    """Swimmers per country and stroke; all versions of a swimmer count."""
    swimmers = warehouse.swimmers.select("swimmer_sk", "nationality")
    # A distinct by swimmer, right after the join by swimmer, needs no further shuffle.
    swum = _with_stroke(warehouse.rankings, warehouse).join(swimmers, "swimmer_sk")
    by_country = swum.select("swimmer_sk", "nationality", "stroke").distinct()
    counts = by_country.groupBy(F.col("nationality").alias("country")).agg(
        *[F.count_if(F.col("stroke") == stroke).alias(name) for stroke, name in STROKE_COUNTS.items()]
    )
    total = sum((F.col(name) for name in STROKE_COUNTS.values()), F.lit(0))
    return counts.select("country", F.lit(CLUB_PLACEHOLDER).alias("club_name"), *STROKE_COUNTS.values()).orderBy(
        F.col("country").asc_nulls_last(), total.desc_nulls_first()
    )


SKETCH_BITS = 12  # a standard error of 1.6 % of a count


def club_sketches(warehouse: Warehouse, bits: int = SKETCH_BITS) -> DataFrame:
    """``country, stroke, swimmers``: a HyperLogLog sketch of the swimmers of each country and stroke.

    Sketches are made before the shuffle and are of a fixed size. Those of several loads can be kept and merged, so
    counts over all loads need no distinct over their rows.
    """
    swum = _with_stroke(warehouse.rankings, warehouse)
    swum = swum.join(warehouse.swimmers.select("swimmer_sk", F.col("nationality").alias("country")), "swimmer_sk")
    return swum.groupBy("country", "stroke").agg(F.hll_sketch_agg("swimmer_sk", bits).alias("swimmers"))


def approximate_club_region_performance(sketches: DataFrame) -> DataFrame:
    """``club_region_performance`` with estimated counts, from the ``club_sketches`` of one or more loads."""
    merged = sketches.groupBy("country", "stroke").agg(F.hll_sketch_estimate(F.hll_union_agg("swimmers")).alias("n"))
    counts = merged.groupBy("country").agg(
        *[F.coalesce(F.sum(F.when(F.col("stroke") == stroke, F.col("n"))), F.lit(0)).alias(name) for stroke, name in STROKE_COUNTS.items()]
    )
    return counts.select("country", F.lit(CLUB_PLACEHOLDER).alias("club_name"), *STROKE_COUNTS.values())


def swimmer_demographics(warehouse: Warehouse) -> DataFrame:
    """Rows of the swimmer dimension per nationality: versions, not persons."""
    counts = warehouse.swimmers.groupBy("nationality").agg(F.count("*").alias("total_swimmers"))
    return counts.select(
        F.col("nationality").alias("swimmer_citizenship"),
        "total_swimmers",
        F.lit(1).alias("birth_countries_count"),
        F.col("nationality").alias("birth_countries"),
    ).orderBy(F.col("total_swimmers").desc())


def _cuts(warehouse: Warehouse, params: Params) -> DataFrame:
    swimmers = current(warehouse.swimmers).select("swimmer_sk", "name", "nationality")
    return (
        _with_stroke(warehouse.rankings, warehouse)
        .join(swimmers, "swimmer_sk")
        .groupBy("name", "nationality", "stroke")
        .agg(F.min("best_time").alias("best_time"))
        .withColumn("olympic_cut", cut_label("best_time", params))
    )


def olympic_cuts(warehouse: Warehouse, params: Params = Params()) -> DataFrame:
    """Best time over all distances of a stroke, and the cut it makes."""
    return _cuts(warehouse, params).orderBy(F.col("stroke").asc_nulls_last(), F.col("best_time").asc_nulls_last())


def _last_five(warehouse: Warehouse, params: Params) -> DataFrame:
    dates = warehouse.competitions.select("competition_sk", "competition_date")
    swims = _with_stroke(warehouse.performance, warehouse).join(dates, "competition_sk")
    newest = Window.partitionBy("swimmer_sk", "stroke").orderBy(
        F.col("competition_date").desc_nulls_first(), "competition_sk", "performance_id"
    )
    # Spark cuts each group to the last swims before the shuffle, so a group's size does not matter.
    last = swims.withColumn("nth", F.row_number().over(newest)).filter(F.col("nth") <= params.last_swims)
    wins = last.groupBy("swimmer_sk", "stroke").agg(F.count_if(F.col("overall_rank") == 1).alias("rank_1_count"))
    swimmers = current(warehouse.swimmers).select("swimmer_sk", "name", "nationality")
    return (
        wins.join(swimmers, "swimmer_sk")
        .groupBy("name", "nationality", "stroke")
        .agg(F.sum("rank_1_count").alias("rank_1_count"))
        .filter(F.col("rank_1_count") >= params.min_wins)
    )


def last_five_rankings(warehouse: Warehouse, params: Params = Params()) -> DataFrame:
    """Wins among the last five swims of a stroke; several swims of one meet count each."""
    return _last_five(warehouse, params).orderBy("name", "stroke")


def _qualifications(warehouse: Warehouse, as_of: dt.date | str | None, params: Params) -> DataFrame:
    # One row per swimmer, stroke and competition replaces three distinct counts over the swims.
    in_time = F.col("time_seconds").between(params.qualifying_from, params.qualifying_to)
    in_rank = F.col("overall_rank").between(1, params.top_places)
    met = (
        _with_stroke(warehouse.performance, warehouse)
        .groupBy("swimmer_sk", "stroke", "competition_sk")
        .agg(F.max(in_time).alias("qualifying"), F.max(in_rank).alias("ranked"))
        .join(warehouse.competitions.select("competition_sk"), "competition_sk", "left_semi")
    )
    totals = (
        met.groupBy("swimmer_sk", "stroke")
        .agg(
            F.count("*").alias("total_competitions"),
            F.count_if("qualifying").alias("qualifying_competitions"),
            F.count_if("ranked").alias("ranked_competitions"),
        )
        .filter(F.col("total_competitions") >= params.min_competitions)
        .filter(F.col("qualifying_competitions") >= params.min_qualifying)
    )
    swimmers = (
        current(warehouse.swimmers)
        .select("swimmer_sk", "name", "nationality", age_years("birth_date", as_of).alias("age"))
        .filter(F.col("age") >= params.min_age)
    )
    return totals.join(swimmers, "swimmer_sk").select(
        "name",
        "nationality",
        "age",
        age_group("age").alias("age_group"),
        "stroke",
        "total_competitions",
        "qualifying_competitions",
        "ranked_competitions",
    )


def olympic_qualifications(
    warehouse: Warehouse, as_of: dt.date | str | None = None, params: Params = Params()
) -> DataFrame:
    """Swimmers with enough competitions and enough qualifying ones, with their age on the day."""
    return _qualifications(warehouse, as_of, params).orderBy("name", "stroke")


def olympic_qualified_swimmers(
    warehouse: Warehouse, as_of: dt.date | str | None = None, params: Params = Params()
) -> DataFrame:
    """Qualified swimmers who made a cut, with their wins among the last five swims.

    The report joins by name. Each side is made distinct first: per name and stroke it then adds at most two
    cuts, and as many wins as differ, so namesakes do not multiply and the joined rows are distinct.
    """
    keys = ["name", "stroke"]
    people = _qualifications(warehouse, as_of, params).drop("ranked_competitions").distinct()
    cuts = _cuts(warehouse, params).filter(F.col("olympic_cut").isin("A Cut", "B Cut"))
    wins = _last_five(warehouse, params).select(*keys, "rank_1_count").distinct()
    joined = people.join(cuts.select(*keys, "olympic_cut").distinct(), keys).join(wins, keys, "left")
    grade = F.when(F.col("olympic_cut") == "A Cut", 1).when(F.col("olympic_cut") == "B Cut", 2).otherwise(3)
    return joined.select(
        "name",
        "nationality",
        "age",
        "age_group",
        "stroke",
        "olympic_cut",
        F.coalesce("rank_1_count", F.lit(0)).alias("rank_1_count"),
        "total_competitions",
        "qualifying_competitions",
    ).orderBy(grade, "stroke", F.col("rank_1_count").desc(), "name")


def qualified_summary(
    warehouse: Warehouse, as_of: dt.date | str | None = None, params: Params = Params()
) -> DataFrame:
    """Qualified swimmers counted by cut and stroke."""
    qualified = olympic_qualified_swimmers(warehouse, as_of, params)
    counts = qualified.groupBy("olympic_cut", "stroke").agg(F.count("*").alias("qualified_count"))
    return counts.orderBy("olympic_cut", "stroke")


def register_views(
    spark: SparkSession, warehouse: Warehouse, as_of: dt.date | str | None = None, params: Params = Params()
) -> None:
    """Make the tables and reports known to SQL text by the names they have in the relational warehouse."""
    frames = {
        "dim_swimmer": warehouse.swimmers,
        "dim_event": warehouse.events,
        "dim_competition": warehouse.competitions,
        "fact_swimming_performance": warehouse.performance,
        "fact_rankings": warehouse.rankings,
        "vw_swimmer_rankings": swimmer_rankings(warehouse),
        "vw_club_region_performance": club_region_performance(warehouse),
        "vw_swimmer_demographics": swimmer_demographics(warehouse),
        "vw_olympic_cuts": olympic_cuts(warehouse, params),
        "vw_last_five_rankings": last_five_rankings(warehouse, params),
        "vw_olympic_qualifications": olympic_qualifications(warehouse, as_of, params),
        "vw_olympic_qualified_swimmers": olympic_qualified_swimmers(warehouse, as_of, params),
    }
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)
