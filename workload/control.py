"""Plain plans for the same results, timed next to the library's to show what its plans buy.

They are what a direct reading of the job gives: numbers from one global window, a Python function per time,
distinct counts over the swims, and reports that join first and aggregate afterwards.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lapstar.functions import age_years, as_int, cut_label, distance, parse_time, stroke
from lapstar.operators import dims
from lapstar.operators.scd2 import current
from lapstar.plans import load
from lapstar.schemas import RAW, RAW_COLUMNS
from lapstar.session import new_path
from lapstar.sources.files import CSV_OPTIONS, read_results
from workload.staging import AS_OF, GATES, SRC, new_database, raw_results, results_folder, warehouse


def surrogate_keys(spark, sf_dir):
    order = Window.orderBy("SwimmerId", *SRC)
    return raw_results(spark, sf_dir).select(*SRC, F.row_number().over(order).alias("row_key"))


def _python_time(column):
    def seconds(text):
        try:
            parts = [float(p) for p in text.split(":")]
            return sum(part * 60**i for i, part in enumerate(reversed(parts)))
        except (AttributeError, ValueError):
            return None

    # Row at a time, without Arrow transfer.
    return F.udf(seconds, "double", useArrow=False)(column)


def parse_results_time(spark, sf_dir):
    return raw_results(spark, sf_dir).select(*SRC, _python_time("Time").alias("time_seconds"))


def fact_rankings(spark, sf_dir):
    """From the raw results again, since the swims are not read back after their load."""
    wh = warehouse(spark, sf_dir)
    swims = raw_results(spark, sf_dir).withColumns({"distance": distance("Event"), "stroke": stroke("Event")})
    joined = (
        swims.join(current(wh.swimmers), F.col("SwimmerId") == F.col("swimmer_id"))
        .join(wh.events, ["distance", "stroke"])
        .join(wh.competitions, F.col("Competition_Competition_Id") == F.col("competition_id"))
    )
    best = joined.groupBy("swimmer_sk", "event_sk").agg(
        F.min(parse_time("Time")).alias("best_time"), F.min(as_int("Overall_Rank")).alias("best_rank")
    )
    return best.withColumn("ranking_id", F.row_number().over(Window.orderBy("swimmer_sk", "event_sk")))


def olympic_cuts(spark, sf_dir):
    wh = warehouse(spark, sf_dir)
    star = wh.performance.join(current(wh.swimmers), "swimmer_sk").join(wh.events, "event_sk")
    best = star.groupBy("name", "nationality", "stroke").agg(F.min("time_seconds").alias("best_time"))
    return best.withColumn("olympic_cut", cut_label("best_time", GATES)).orderBy("stroke", "best_time")


def olympic_qualifications(spark, sf_dir):
    wh = warehouse(spark, sf_dir)
    star = (
        wh.performance.join(current(wh.swimmers), "swimmer_sk")
        .join(wh.events, "event_sk")
        .join(wh.competitions, "competition_sk")
    )
    in_time = F.col("time_seconds").between(GATES.qualifying_from, GATES.qualifying_to)
    in_rank = F.col("overall_rank").between(1, GATES.top_places)
    return (
        star.withColumn("years", age_years("birth_date", AS_OF))
        .filter(F.col("years") >= GATES.min_age)
        .groupBy("swimmer_sk", "name", "nationality", "years", "stroke")
        .agg(
            F.countDistinct("competition_sk").alias("total"),
            F.countDistinct(F.when(in_time, F.col("competition_sk"))).alias("qualifying"),
            F.countDistinct(F.when(in_rank, F.col("competition_sk"))).alias("ranked"),
        )
        .filter((F.col("total") >= GATES.min_competitions) & (F.col("qualifying") >= GATES.min_qualifying))
        .orderBy("name", "stroke")
    )


def swimmer_rankings(spark, sf_dir):
    wh = warehouse(spark, sf_dir)
    star = wh.performance.join(wh.swimmers, "swimmer_sk").join(wh.events, "event_sk")
    own = Window.partitionBy("swimmer_sk", "stroke").orderBy(F.col("time_seconds").asc_nulls_last())
    ranked = star.withColumn("rank", F.rank().over(own))
    return ranked.groupBy("name", "stroke").agg(*[F.count_if(F.col("rank") == k).alias(f"n{k}") for k in range(1, 6)])


def _numbered(df, order, name):
    return df.withColumn(name, F.row_number().over(Window.orderBy(*order)))


def load_files(spark, sf_dir):
    """The whole job from files, step by step: two jobs per file for the profile, then dims, facts, rankings."""
    folder = results_folder(spark, sf_dir)
    for name in {path.rsplit("/", 2)[1] for path in read_results(spark, folder).inputFiles()}:
        one = spark.read.schema(RAW).options(**CSV_OPTIONS).csv(f"{folder}/{name}")
        one.count()
        one.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in RAW_COLUMNS]).collect()
    raw = read_results(spark, folder)
    raw.count()
    out = new_path(spark, "plain")

    def stored(df, name):
        df.write.parquet(f"{out}/{name}")
        return spark.read.parquet(f"{out}/{name}")

    swimmers = stored(_numbered(dims.project_swimmers(raw), ["swimmer_id"], "swimmer_sk"), "swimmers")
    events = stored(_numbered(dims.project_events(raw), ["distance", "stroke"], "event_sk"), "events")
    meets = stored(_numbered(dims.project_competitions(raw), ["competition_id"], "competition_sk"), "meets")
    joined = (
        raw.withColumns({"distance": distance("Event"), "stroke": stroke("Event"), "time_seconds": _python_time("Time")})
        .join(swimmers.select("swimmer_sk", F.col("swimmer_id").alias("SwimmerId")), "SwimmerId")
        .join(events, ["distance", "stroke"])
        .join(meets, F.col("Competition_Competition_Id") == F.col("competition_id"))
        .withColumn("overall_rank", as_int("Overall_Rank"))
        .select("swimmer_sk", "event_sk", "competition_sk", "time_seconds", "overall_rank", as_int("Age").alias("age"))
    )
    swims = _numbered(joined, [F.lit(1)], "performance_id")
    stored(swims, "swims")
    best = swims.groupBy("swimmer_sk", "event_sk").agg(F.min("time_seconds"), F.min("overall_rank").alias("best_rank"))
    return stored(best.toDF("swimmer_sk", "event_sk", "best_time", "best_rank"), "rankings")


def load_files_by_library(spark, sf_dir):
    loaded, profile = load.load_files(spark, results_folder(spark, sf_dir), new_database(spark), "one", AS_OF)
    profile.collect()
    return loaded.rankings


CONTROL = {
    f.__name__: f
    for f in (
        surrogate_keys,
        parse_results_time,
        fact_rankings,
        olympic_cuts,
        olympic_qualifications,
        swimmer_rankings,
        load_files,
        load_files_by_library,
    )
}
