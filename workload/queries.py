"""One query per operator: a callable over (spark, data folder), all on whole tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lapstar import functions as fn
from lapstar.operators import dims, facts, quality, results, scd2
from lapstar.operators.joins import join_null_safe
from lapstar.operators.keys import number_rows
from lapstar.plans import load, reports
from lapstar.schemas import ENTRY_CAPS, RAW, REQUIRED_SWIMMER_COLUMNS
from lapstar.session import new_path, save
from lapstar.sources import files, tables
from lapstar.streaming import files as streaming
from workload.staging import (
    AS_OF,
    GATES,
    SRC,
    new_database,
    once,
    raw_results,
    results_folder,
    scd_pair,
    warehouse,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def competition() -> Column:
    return F.col("Competition_Competition_Id").alias("competition_id")



def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _rows_by_competition(raw: DataFrame) -> DataFrame:
    return raw.groupBy(competition()).agg(F.count("*").alias("rows"))


def _arrivals(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The raw results as they come: the meets up to a day, then all later ones."""
    raw = raw_results(spark, sf_dir)
    early = fn.as_date("Competition_Date") <= F.lit("1998-03-31").cast("date")
    return [raw.filter(early), raw.filter(~F.coalesce(early, F.lit(False)))]


# Sources and sinks


@query
def find_results(spark, sf_dir):
    """Rows in a folder of results and in one without; the latter is an error."""
    found = None
    for name, path in (("given", results_folder(spark, sf_dir)), ("missing", new_path(spark, "missing"))):
        try:
            rows = files.read_results(spark, path).agg(F.count("*").alias("rows"))
        except FileNotFoundError:
            rows = spark.range(1).select(F.lit(None).cast("bigint").alias("rows"))
        rows = rows.select(F.lit(name).alias("folder"), F.col("rows").isNotNull().alias("found"), "rows")
        found = rows if found is None else found.unionByName(rows)
    return found


@query
def scan_results_csv(spark, sf_dir):
    raw = files.read_results(spark, results_folder(spark, sf_dir))
    return raw.select(
        F.col("SwimmerId").alias("swimmer_id"),
        F.col("Name").alias("name"),
        F.col("Birth_Date").alias("birth_date"),
        F.col("Gender").alias("gender"),
        F.col("Citizenship").alias("citizenship"),
        F.col("Event").alias("event"),
        F.col("Time").alias("time"),
        F.col("Overall_Rank").alias("overall_rank"),
        F.col("Age").alias("age"),
        competition(),
        F.col("Competition_Date").alias("competition_date"),
        F.col("Competition_Country").alias("competition_country"),
        F.col("Competition_Level").alias("competition_level"),
    )


@query
def write_results_by_competition(spark, sf_dir):
    path = new_path(spark, "written")
    files.write_results(raw_results(spark, sf_dir), path, compression="gzip")
    return _rows_by_competition(files.read_results(spark, path))


@query
def read_table_or_empty(spark, sf_dir):
    database = new_database(spark)
    raw = raw_results(spark, sf_dir)
    tables.append(raw.select(competition()), f"{database}.present")
    schema = raw.select(competition()).schema
    found = [(name, tables.read_table(spark, f"{database}.{name}", schema)) for name in ("present", "missing")]
    counted = [df.agg(F.count("*").alias("rows")).select(F.lit(n).alias("table_name"), "rows") for n, df in found]
    return counted[0].unionByName(counted[1])


@query
def overwrite_swap(spark, sf_dir):
    name = f"{new_database(spark)}.swims"
    tables.overwrite_swap(raw_results(spark, sf_dir).select(competition(), "Overall_Rank"), name)
    tables.overwrite_swap(spark.read.table(name).filter("Overall_Rank <> '1'"), name)
    return spark.read.table(name).groupBy("competition_id").agg(F.count("*").alias("rows"))


@query
def append_rows(spark, sf_dir):
    name = f"{new_database(spark)}.swims"
    for part in _arrivals(spark, sf_dir):
        tables.append(part.select(*SRC), name)
    return quality.row_count(spark.read.table(name))


# Profiling and constraints


@query
def profile_by_file(spark, sf_dir):
    raw = files.read_results(spark, results_folder(spark, sf_dir))
    by_file = quality.profile(raw.withColumn("file", F.col("_metadata.file_path")), "file", raw.columns)
    by_competition = F.regexp_extract("file", r"_([^_/]+)_results\.csv/", 1).alias("competition_id")
    return by_file.groupBy(by_competition).agg(
        F.sum("rows").alias("rows"),
        F.sum("null_time").alias("null_time"),
        F.sum("null_approving_authority").alias("null_authority"),
    )


@query
def null_counts(spark, sf_dir):
    return quality.null_counts(
        raw_results(spark, sf_dir), [*REQUIRED_SWIMMER_COLUMNS, "Time", "Approving_Authority"]
    )


@query
def row_count(spark, sf_dir):
    return quality.row_count(raw_results(spark, sf_dir))


def _with_missing_lines(spark, sf_dir) -> DataFrame:
    line = F.when(F.col("src_line") != 7, F.col("src_line")).alias("src_line")
    return raw_results(spark, sf_dir).select("src_order", line)


@query
def dq_primary_key(spark, sf_dir):
    return quality.duplicates(_with_missing_lines(spark, sf_dir), ["src_order", "src_line"])


@query
def dq_unique(spark, sf_dir):
    return quality.duplicates(_with_missing_lines(spark, sf_dir), ["src_order", "src_line"], allow_null=True)


@query
def dq_varchar_len(spark, sf_dir):
    limits = {"SwimmerId": 50, "Name": 255, "Gender": 1, "Citizenship": 3, "Event": 16, "Sponsor": 5}
    return quality.too_long(raw_results(spark, sf_dir), limits)


@query
def dq_foreign_key(spark, sf_dir):
    """Against a dimension that lacks the swimmers of one nation."""
    wh = warehouse(spark, sf_dir)
    return quality.orphans(wh.performance, wh.swimmers.filter("nationality <> 'N07'"), "swimmer_sk")


# Projections, filters, scalar functions


@query
def project_swimmers(spark, sf_dir):
    return dims.project_swimmers(raw_results(spark, sf_dir))


@query
def filter_current(spark, sf_dir):
    existing, feed = scd_pair(spark, sf_dir)
    history = scd2.merge(existing, feed, "k", ["name", "nat"], AS_OF)
    return scd2.current(history).select(F.col("k").alias("swimmer_id"), "version")


@query
def filter_between(spark, sf_dir):
    date = fn.as_date("Competition_Date")
    swims = raw_results(spark, sf_dir).select(
        F.col("SwimmerId").alias("swimmer_id"), competition(), fn.parse_time("Time").alias("time_seconds"),
        date.alias("swum_on"),
    )
    return swims.filter(
        F.col("time_seconds").between(GATES.qualifying_from, GATES.qualifying_to)
        & F.col("swum_on").between(F.lit("1996-01-01").cast("date"), F.lit("1998-12-31").cast("date"))
    ).drop("swum_on")


@query
def eligible_entries(spark, sf_dir):
    return results.eligible(raw_results(spark, sf_dir)).select(*SRC)


@query
def parse_results(spark, sf_dir):
    typed = fn.parse_results(raw_results(spark, sf_dir))
    return typed.select(*SRC, "birth_date", "age", "gender", "overall_rank", "competition_date")


@query
def parse_event(spark, sf_dir):
    events = raw_results(spark, sf_dir).select(F.col("Event").alias("event")).distinct()
    return events.select("event", fn.distance("event").alias("distance"), fn.stroke("event").alias("stroke"))


@query
def parse_time(spark, sf_dir):
    texts = raw_results(spark, sf_dir).select(F.col("Time").alias("time_text")).distinct()
    return texts.select("time_text", fn.parse_time("time_text").alias("time_seconds"))


@query
def format_time(spark, sf_dir):
    seconds = warehouse(spark, sf_dir).performance.select("time_seconds").distinct()
    return seconds.select(fn.format_time("time_seconds").alias("time_text"), "time_seconds")


def _swimmers(spark, sf_dir) -> DataFrame:
    return dims.project_swimmers(raw_results(spark, sf_dir))


@query
def age_years(spark, sf_dir):
    return _swimmers(spark, sf_dir).select("swimmer_id", fn.age_years("birth_date", AS_OF).alias("age"))


@query
def age_groups(spark, sf_dir):
    group = fn.age_group(fn.age_years("birth_date", AS_OF))
    return _swimmers(spark, sf_dir).groupBy(group.alias("age_group")).agg(F.count("*").alias("n"))


@query
def age_days365(spark, sf_dir):
    return _swimmers(spark, sf_dir).select("swimmer_id", fn.age_days365("birth_date", AS_OF).alias("age"))


@query
def education_band(spark, sf_dir):
    age = fn.age_years("birth_date", AS_OF)
    return _swimmers(spark, sf_dir).select("swimmer_id", fn.education_band(age).alias("band"))


@query
def history_array(spark, sf_dir):
    """The printed list of all-time histories, read back as numbers, for every swim."""
    swims = results.rolling_history(raw_results(spark, sf_dir), tie=SRC)
    times = swims.withColumn("times", fn.history_array(fn.history_text("history")))
    return times.select(
        F.col("SwimmerId").alias("swimmer_id"),
        F.size("times").cast("bigint").alias("n_times"),
        F.get("times", F.lit(0)).alias("first_time"),
        F.try_element_at("times", F.lit(-1)).alias("last_time"),
    )


# Keys, dimensions, facts


@query
def surrogate_keys(spark, sf_dir):
    swims = raw_results(spark, sf_dir).select("SwimmerId", *SRC)
    return number_rows(swims, ["SwimmerId", *SRC], "row_key").drop("SwimmerId")


@query
def distinct_events(spark, sf_dir):
    return dims.project_events(raw_results(spark, sf_dir))


@query
def dim_event(spark, sf_dir):
    return dims.events(raw_results(spark, sf_dir)).whole()


@query
def dim_competition(spark, sf_dir):
    return dims.competitions(raw_results(spark, sf_dir)).whole()


@query
def dim_swimmer_initial(spark, sf_dir):
    feed = dims.swimmer_feed(raw_results(spark, sf_dir))
    return dims.swimmers(feed, AS_OF).whole().drop("created_at", "updated_at")


@query
def scd2_changes(spark, sf_dir):
    existing, feed = scd_pair(spark, sf_dir)
    return scd2.classify(existing, feed, "k", ["name", "nat"])


@query
def scd2_snapshot(spark, sf_dir):
    existing, feed = scd_pair(spark, sf_dir)
    return scd2.merge(existing, feed, "k", ["name", "nat"], AS_OF)


@query
def build_performance(spark, sf_dir):
    wh = warehouse(spark, sf_dir)
    return facts.performance(raw_results(spark, sf_dir), wh.swimmers, wh.events, wh.competitions, SRC)


@query
def fact_rankings(spark, sf_dir):
    return facts.rankings(warehouse(spark, sf_dir).performance)


@query
def warehouse_row_counts(spark, sf_dir):
    loaded = load.run_load(spark, raw_results(spark, sf_dir), new_database(spark), "initial", AS_OF, SRC)
    return load.row_counts(loaded)


# Loads that are replaced, repeated or find nothing new


def _replaced(spark, sf_dir):
    """Two loads, then the first again with half of its swims, some of them without a time. Loaded once."""

    def build() -> str:
        early, late = _arrivals(spark, sf_dir)
        database = new_database(spark)
        load.run_load(spark, early, database, "early", AS_OF, SRC)
        load.run_load(spark, late, database, "late", AS_OF, SRC)
        less = early.filter("src_line % 2 = 1").withColumn("Time", F.when(F.col("src_line") != 1, F.col("Time")))
        load.run_load(spark, less, database, "early", AS_OF, SRC)
        return database

    return load.read_warehouse(spark, once(spark, sf_dir, "replaced", build))


@query
def replaced_load_rankings(spark, sf_dir):
    wh = _replaced(spark, sf_dir)
    named = wh.rankings.join(wh.swimmers, "swimmer_sk").join(wh.events, "event_sk")
    return named.select("swimmer_id", "distance", "stroke", "best_time", "best_rank")


@query
def replaced_load_cuts(spark, sf_dir):
    return reports.olympic_cuts(_replaced(spark, sf_dir), GATES)


@query
def replaced_load_club(spark, sf_dir):
    return reports.club_region_performance(_replaced(spark, sf_dir))


@query
def replaced_load_qualified(spark, sf_dir):
    return reports.olympic_qualified_swimmers(_replaced(spark, sf_dir), AS_OF, GATES)


def _differing(old: DataFrame, new: DataFrame) -> DataFrame:
    """How many rows of either side the other lacks, repeats counted, from one shuffle of both."""
    sides = old.withColumn("_n", F.lit(1)).unionByName(new.withColumn("_n", F.lit(-1)))
    surplus = sides.groupBy(*old.columns).agg(F.abs(F.sum("_n")).alias("_n"))
    return surplus.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("differing"))


@query
def repeat_older_load(spark, sf_dir):
    """Rows per table that are not the same after an older load, with names that were changed since, came again."""
    early, late = _arrivals(spark, sf_dir)
    late = late.withColumn("Name", F.concat("Name", F.lit(" II")))
    database = new_database(spark)
    load.run_load(spark, early, database, "early", AS_OF, SRC)
    before = load.run_load(spark, late, database, "late", AS_OF, SRC)
    before = [save(frame, "before") for frame in (before.swimmers, before.events, before.competitions,
                                                  before.performance, before.rankings)]
    after = load.run_load(spark, early, database, "early", AS_OF, SRC)
    after = [after.swimmers, after.events, after.competitions, after.performance, after.rankings]
    found = None
    for name, old, new in zip(load.TABLES, before, after, strict=True):
        moved = _differing(old, new)
        one = moved.crossJoin(new.agg(F.count("*").alias("rows"))).select(F.lit(name).alias("table_name"), "rows", "differing")
        one = save(one, "differing")  # so that the table's shuffles go before those of the next come
        found = one if found is None else found.unionByName(one)
    return found


@query
def load_files_twice(spark, sf_dir):
    """Swims per competition after a folder was loaded, more files came, and it was loaded under other ids."""
    path, database = new_path(spark, "arriving"), new_database(spark)
    for number, part in enumerate([*_arrivals(spark, sf_dir), None]):
        if part is not None:
            files.write_results(part, path, compression="gzip")
        loaded, _ = load.load_files(spark, path, database, f"load-{number}", AS_OF)
    return loaded.performance.join(loaded.competitions, "competition_sk").groupBy("competition_id").agg(
        F.count("*").alias("rows")
    )


@query
def corrected_file(spark, sf_dir):
    """Swims and hundredths per competition after results files came again, as long as before or shorter, or are gone."""
    path, database = new_path(spark, "corrected"), new_database(spark)
    raw = raw_results(spark, sf_dir)
    files.write_results(raw, path, compression="gzip")
    load.load_files(spark, path, database, "first", AS_OF)
    month = F.substring("Competition_Competition_Id", 2, 6).cast("int")
    digit = F.translate(F.right("Time", F.lit(1)), "0123456789", "9876543210")
    other_digit = F.concat(F.expr("left(Time, length(Time) - 1)"), digit)
    corrected = raw.filter((month % 3 == 0) | ((month % 3 == 1) & (F.col("src_line") % 2 == 1)))
    corrected = save(corrected.withColumn("Time", F.when(month % 3 == 0, other_digit).otherwise(F.col("Time"))), "corrected")
    gone = raw.filter((month % 3 != 2) | (month % 2 == 0))
    names = gone.select(fn.file_name("Competition_Date", "Competition_Competition_Id").alias("unit")).distinct()
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    for row in names.collect():  # one a competition
        system.delete(spark._jvm.org.apache.hadoop.fs.Path(folder, f"results={row['unit']}"), True)
    files.write_results(corrected, path, compression="gzip")
    loaded, _ = load.load_files(spark, path, database, "second", AS_OF)
    swims = loaded.performance.join(loaded.competitions, "competition_sk")
    return swims.groupBy("competition_id").agg(
        F.count("*").alias("rows"), F.sum(F.round(F.col("time_seconds") * 100).cast("bigint")).alias("hundredths")
    )


@query
def swimmer_history(spark, sf_dir):
    """The versions of all swimmers after later meets came with other names; the known rows are not written again."""
    early, late = _arrivals(spark, sf_dir)
    database = new_database(spark)
    load.run_load(spark, early, database, "early", "2018-06-29", SRC)
    loaded = load.run_load(spark, late.withColumn("Name", F.concat("Name", F.lit(" II"))), database, "late", AS_OF, SRC)
    return loaded.swimmers.select("swimmer_id", "name", "version", "is_current", "valid_from", "valid_to")


@query
def compacted_load(spark, sf_dir):
    """Swims, their times and best places per competition after loads were merged twice over, and one of them came again."""
    raw, database = raw_results(spark, sf_dir), new_database(spark)
    fifth = F.pmod(F.substring("Competition_Competition_Id", 2, 6).cast("int"), F.lit(5))
    for number in range(5):
        load.run_load(spark, raw.filter(fifth == number), database, f"load-{number}", AS_OF, SRC)
        load.compact(spark, database, 2)
    again = raw.filter((fifth == 1) & (F.col("src_line") % 2 == 1))
    loaded = load.run_load(spark, again, database, "load-1", AS_OF, SRC)
    swims = loaded.performance.groupBy("competition_sk", "swimmer_sk", "event_sk").agg(
        F.count("*").alias("rows"), F.sum(F.round(F.col("time_seconds") * 100).cast("bigint")).alias("hundredths")
    )
    best = loaded.rankings.select("swimmer_sk", "event_sk", "best_rank")
    return swims.join(best, ["swimmer_sk", "event_sk"]).join(loaded.competitions, "competition_sk").groupBy(
        "competition_id"
    ).agg(F.sum("rows").alias("rows"), F.sum("hundredths").alias("hundredths"), F.min("best_rank").alias("best_rank"))


@query
def reset_warehouse(spark, sf_dir):
    """Rows per table after a load, and after a reset."""
    database = new_database(spark)
    early, _ = _arrivals(spark, sf_dir)
    loaded = save(load.row_counts(load.run_load(spark, early, database, "early", AS_OF, SRC)), "counts")
    load.reset(spark, database)
    left = load.row_counts(load.read_warehouse(spark, database)).withColumnRenamed("rows", "rows_after")
    return loaded.join(left, "table_name")


# Result-building jobs


@query
def event_places(spark, sf_dir):
    return results.places(raw_results(spark, sf_dir), SRC).select(*SRC, "place", F.col("Top_5").alias("top_5"))


@query
def event_top5(spark, sf_dir):
    top = results.top5(raw_results(spark, sf_dir), SRC)
    return top.select(
        competition(), F.col("Event").alias("event"), F.col("place").cast("bigint").alias("place"),
        F.col("SwimmerId").alias("swimmer_id"),
    )


@query
def place_counts(spark, sf_dir):
    return results.place_counts(raw_results(spark, sf_dir), SRC)


@query
def personal_bests(spark, sf_dir):
    best = results.personal_bests(raw_results(spark, sf_dir), SRC)
    return best.select(*SRC, "best_so_far", "is_personal_best")


@query
def rolling_history(spark, sf_dir):
    swims = results.rolling_history(raw_results(spark, sf_dir), tie=SRC)
    text = F.array_join(F.transform("history", fn.format_time), ";")
    return swims.select(*SRC, F.size("history").cast("bigint").alias("n_times"), text.alias("history"))


def _summary_rows(summary: DataFrame) -> DataFrame:
    """The map of times is compared as text, in hundredths: ``50:2530;2610|100:`` and so on, by distance."""
    sizes = F.transform(F.map_values("Historical_Records"), lambda times: F.size(times).cast("bigint"))
    total = F.aggregate(sizes, F.lit(0).cast("bigint"), lambda a, b: a + b)
    entries = F.array_sort(F.map_entries("Historical_Records"))
    texts = F.transform(
        entries,
        lambda e: F.concat(
            e["key"].cast("string"),
            F.lit(":"),
            F.array_join(F.transform(e["value"], lambda t: F.round(t * 100).cast("bigint").cast("string")), ";"),
        ),
    )
    return summary.select(
        F.col("id").alias("swimmer_id"),
        F.col("Stroke").alias("stroke"),
        *[F.col(f"Rank{k}_Count").alias(f"rank{k}_count") for k in range(1, 6)],
        total.alias("n_times"),
        F.array_join(texts, "|").alias("records"),
    )


@query
def rankings_summary(spark, sf_dir):
    return _summary_rows(results.rankings_summary(raw_results(spark, sf_dir), tie=SRC))


@query
def summary_csv(spark, sf_dir):
    """The summary as CSV, read again."""
    path = new_path(spark, "summary")
    files.write_summary(results.rankings_summary(raw_results(spark, sf_dir), tie=SRC), path, compression="gzip")
    return _summary_rows(files.read_summary(spark, path))


@query
def sql_parse_time(spark, sf_dir):
    """The registered function in SQL text."""
    fn.register(spark)
    raw = raw_results(spark, sf_dir)
    return spark.sql("SELECT DISTINCT Time AS time_text, parse_time(Time) AS time_seconds FROM {raw}", raw=raw)


@query
def event_labels(spark, sf_dir):
    raw = raw_results(spark, sf_dir)
    return raw.select(
        fn.event_label(fn.distance("Event"), fn.stroke("Event")).alias("label"),
        fn.competition_code("Competition_Level", F.month(fn.as_date("Competition_Date"))).alias("code"),
        fn.file_name("Competition_Date", "Competition_Competition_Id").alias("file"),
    ).distinct()


@query
def top_entries(spark, sf_dir):
    """Capped levels, one that is not listed (May) and a null one (November)."""
    month = F.month(fn.as_date("Competition_Date"))
    level = F.when(month == 5, "Club").when(month != 11, F.col("Competition_Level"))
    entries = results.top_entries(raw_results(spark, sf_dir).withColumn("Competition_Level", level), ENTRY_CAPS, SRC)
    return entries.select(*SRC, F.col("Competition_Level").alias("level"), "entry_no")


@query
def completed_results(spark, sf_dir):
    """Raw results with places, flags and histories filled in."""
    done = results.as_results(raw_results(spark, sf_dir), SRC)
    history = fn.history_array("Historical_Times")
    return done.select(
        *SRC, F.col("Overall_Rank").cast("bigint").alias("place"), F.col("Top_5").alias("top_5"),
        F.col("Is_Personal_Best").alias("is_best"), F.col("Is_Valid_Record").alias("is_valid"),
        F.size(history).cast("bigint").alias("n_times"), F.try_element_at(history, F.lit(-1)).alias("last_time"),
    )


# Reports


@query
def swimmer_rankings(spark, sf_dir):
    return reports.swimmer_rankings(warehouse(spark, sf_dir))


@query
def club_region_performance(spark, sf_dir):
    return reports.club_region_performance(warehouse(spark, sf_dir))


@query
def approximate_club_region(spark, sf_dir):
    """The exact counts, and whether those from the merged sketches of two halves are within five standard errors."""
    wh = warehouse(spark, sf_dir)
    halves = [replace(wh, rankings=wh.rankings.filter(F.pmod("event_sk", F.lit(2)) == k)) for k in range(2)]
    sketches = reports.club_sketches(halves[0]).unionByName(reports.club_sketches(halves[1]))
    names = list(reports.STROKE_COUNTS.values())
    rough = reports.approximate_club_region_performance(sketches).withColumnsRenamed({n: f"rough_{n}" for n in names})
    both = join_null_safe(reports.club_region_performance(wh), rough.drop("club_name"), ["country"], "left")
    near = [F.abs(F.col(n) - F.col(f"rough_{n}")) <= F.ceil(F.col(n) * 5 * 1.04 / 2 ** (reports.SKETCH_BITS / 2)) for n in names]
    within = F.coalesce(reduce(lambda a, b: a & b, near), F.lit(False))
    return both.select("country", *names, within.alias("within_bound"))


@query
def swimmer_demographics(spark, sf_dir):
    return reports.swimmer_demographics(warehouse(spark, sf_dir))


@query
def olympic_cuts(spark, sf_dir):
    return reports.olympic_cuts(warehouse(spark, sf_dir), GATES)


@query
def last_five_rankings(spark, sf_dir):
    return reports.last_five_rankings(warehouse(spark, sf_dir), GATES)


@query
def olympic_qualifications(spark, sf_dir):
    return reports.olympic_qualifications(warehouse(spark, sf_dir), AS_OF, GATES)


@query
def olympic_qualified_swimmers(spark, sf_dir):
    return reports.olympic_qualified_swimmers(warehouse(spark, sf_dir), AS_OF, GATES)


@query
def qualified_summary(spark, sf_dir):
    return reports.qualified_summary(warehouse(spark, sf_dir), AS_OF, GATES)


# Reports in their order: the position of each row, with the columns that decide it


def _positions(report: DataFrame, *columns: str) -> DataFrame:
    rows = report.select(*columns).withColumn("_row", F.monotonically_increasing_id())
    return number_rows(rows, ["_row"], "position").drop("_row")


@query
def olympic_cuts_order(spark, sf_dir):
    return _positions(reports.olympic_cuts(warehouse(spark, sf_dir), GATES), "stroke", "best_time")


@query
def qualified_order(spark, sf_dir):
    report = reports.olympic_qualified_swimmers(warehouse(spark, sf_dir), AS_OF, GATES)
    return _positions(report, "olympic_cut", "stroke", "rank_1_count", "name")


@query
def club_region_order(spark, sf_dir):
    return _positions(reports.club_region_performance(warehouse(spark, sf_dir)), "country")


# Streams: the files arrive in two steps, and a third run finds nothing new


def _run_on_arrival(spark, sf_dir, path: str, run: Callable[[], object]) -> None:
    for part in _arrivals(spark, sf_dir):
        files.write_results(part, path, compression="gzip")
        run()
    run()


@query
def stream_ingest(spark, sf_dir):
    path, sink, checkpoint = (new_path(spark, name) for name in ("arriving", "ingested", "progress"))
    _run_on_arrival(spark, sf_dir, path, lambda: streaming.ingest(spark, path, sink, checkpoint))
    return _rows_by_competition(spark.read.parquet(sink))


@query
def stream_archive(spark, sf_dir):
    """Rows per competition of the files that wait and of those that were moved away after use: together all of them."""
    names = ("arriving", "ingested", "progress", "archive")
    path, sink, checkpoint, archive = (new_path(spark, name) for name in names)
    _run_on_arrival(spark, sf_dir, path, lambda: streaming.ingest(spark, path, sink, checkpoint, archive=archive))
    found = spark.read.schema(RAW).options(**files.CSV_OPTIONS)
    places = [place for place in (path, archive) if files.holds_results(spark, place)]
    return _rows_by_competition(found.option("recursiveFileLookup", "true").csv(places))


@query
def stream_load_facts(spark, sf_dir):
    path, checkpoint = new_path(spark, "arriving"), new_path(spark, "progress")
    database = new_database(spark)
    _run_on_arrival(spark, sf_dir, path, lambda: streaming.load_stream(spark, path, database, checkpoint, AS_OF))
    loaded = load.read_warehouse(spark, database)
    named = loaded.performance.join(loaded.competitions, "competition_sk")
    return named.groupBy("competition_id").agg(
        F.count("*").alias("rows"), F.min("time_seconds").alias("min_time")
    )


@query
def stream_rankings(spark, sf_dir):
    path, sink, checkpoint = (new_path(spark, name) for name in ("arriving", "rankings", "progress"))
    _run_on_arrival(spark, sf_dir, path, lambda: streaming.rankings_stream(spark, path, sink, checkpoint))
    return streaming.current_rankings(spark, sink)
