"""Jobs that complete raw results: places, top places, personal bests, histories, eligibility, summary.

``tie`` names columns that settle what the order of a job leaves open; by default the source columns of
``read_results``, where the rows have them.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lapstar.functions.columns import as_date, as_int, distance, history_text, parse_time, stroke, top_flag
from lapstar.operators.joins import join_null_safe
from lapstar.operators.scans import nulls_last, number_in_groups, running_min, running_min_and_list, trailing_list
from lapstar.schemas import ENTRY_CAPS, HISTORY_LENGTH, STROKE_DISTANCES, tie_columns

COMPETITION_EVENT = ["Competition_Competition_Id", "Event"]
RANKS = range(1, 6)


def _timed(raw: DataFrame) -> DataFrame:
    return raw.withColumn("time_seconds", parse_time("Time"))


def _fastest_first(raw: DataFrame, tie: list[str] | None) -> list[Column | str]:
    return [*nulls_last("time_seconds"), "SwimmerId", *tie_columns(raw, tie)]


def places(raw: DataFrame, tie: list[str] | None = None) -> DataFrame:
    """Place of every swim in its event of its competition, and the top-5 flag. A swim without a time has no place."""
    placed = number_in_groups(_timed(raw), COMPETITION_EVENT, _fastest_first(raw, tie), "place")
    placed = placed.withColumn("place", F.when(F.col("time_seconds").isNotNull(), F.col("place")))
    return placed.withColumn("Top_5", top_flag("place"))


def top5(raw: DataFrame, tie: list[str] | None = None, k: int = 5) -> DataFrame:
    """The first ``k`` places of each event of each competition.

    The filter on the row number lets Spark cut every group to ``k`` rows before the shuffle.
    """
    window = Window.partitionBy(*COMPETITION_EVENT).orderBy(*_fastest_first(raw, tie))
    timed = _timed(raw).filter(F.col("time_seconds").isNotNull())
    return timed.withColumn("place", F.row_number().over(window)).filter(F.col("place") <= k)


def rank_counts(place: str) -> list[Column]:
    return [F.count_if(F.col(place) == k).alias(f"rank{k}_count") for k in RANKS]


def place_counts(raw: DataFrame, tie: list[str] | None = None) -> DataFrame:
    """How often each swimmer took places 1 to 5, per stroke."""
    return top5(raw, tie).groupBy(F.col("SwimmerId").alias("swimmer_id"), stroke("Event").alias("stroke")).agg(
        *rank_counts("place")
    )


def _career(raw: DataFrame) -> DataFrame:
    return _timed(raw).withColumns(
        {
            "distance": distance("Event"),
            "stroke": stroke("Event"),
            "swim_date": as_date("Competition_Date"),
        }
    )


CAREER_KEYS = ["SwimmerId", "stroke", "distance"]


def _oldest_first(raw: DataFrame, tie: list[str] | None) -> list[str]:
    return ["swim_date", "Competition_Competition_Id", *tie_columns(raw, tie)]


def _best_flag(swims: DataFrame) -> DataFrame:
    flag = F.coalesce(F.col("time_seconds") == F.col("best_so_far"), F.lit(False))
    return swims.withColumn("is_personal_best", flag)


def personal_bests(raw: DataFrame, tie: list[str] | None = None) -> DataFrame:
    """Best time so far of swimmer, stroke and distance at every swim, and whether the swim set or met it."""
    return _best_flag(
        running_min(_career(raw), CAREER_KEYS, _oldest_first(raw, tie), "time_seconds", "best_so_far")
    )


def rolling_history(raw: DataFrame, length: int = HISTORY_LENGTH, tie: list[str] | None = None) -> DataFrame:
    """The last ``length`` times of swimmer, stroke and distance up to every swim, oldest first."""
    return trailing_list(_career(raw), CAREER_KEYS, _oldest_first(raw, tie), "time_seconds", length, "history")


def eligible(raw: DataFrame) -> DataFrame:
    """Entries allowed to start.

    Not disqualified; at least two years of residency for foreigners; fully vaccinated at national level.
    """
    home = F.col("Citizenship").eqNullSafe(F.col("Birth_Country"))
    resident = home | F.coalesce(as_int("Residency_Years") >= 2, F.lit(False))
    vaccinated = ~F.col("Competition_Level").eqNullSafe("National") | F.col("Vaccination_Status").eqNullSafe(
        "Fully Vaccinated"
    )
    return raw.filter(~F.col("Is_Disqualified").eqNullSafe("True") & resident & vaccinated)


def top_entries(raw: DataFrame, caps: dict[str, int] = ENTRY_CAPS, tie: list[str] | None = None) -> DataFrame:
    """The first entries of each event of each competition and level, up to the level's cap.

    A level that ``caps`` does not list, or a null one, has no cap: all its entries stay. For listed levels the
    largest cap is a constant filter, so that Spark cuts the groups before the shuffle.
    """
    group, order = [*COMPETITION_EVENT, "Competition_Level"], ["SwimmerId", *tie_columns(raw, tie)]
    cap = F.create_map(*[F.lit(v) for v in chain.from_iterable(caps.items())])[F.col("Competition_Level")]
    listed = F.coalesce(F.col("Competition_Level").isin(*caps), F.lit(False))
    number = F.row_number().over(Window.partitionBy(*group).orderBy(*order)).cast("bigint")
    capped = raw.filter(listed).withColumn("entry_no", number).filter(F.col("entry_no") <= max(caps.values()))
    free = number_in_groups(raw.filter(~listed), group, order, "entry_no")
    return capped.filter(F.col("entry_no") <= cap).unionByName(free)


def _histories(raw: DataFrame, length: int, tie: list[str] | None) -> DataFrame:
    """Per swimmer the listed strokes and distances swum, each with its last ``length`` times, oldest first."""
    swims = _career(raw).filter(F.col("time_seconds").isNotNull() & F.col("distance").isNotNull())
    swims = swims.filter(F.col("stroke").isin(*STROKE_DISTANCES))
    order = _oldest_first(raw, tie)
    newest = Window.partitionBy(*CAREER_KEYS).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    last = swims.withColumn("_age", F.row_number().over(newest)).filter(F.col("_age") <= length)
    # Bounded lists: at most ``length`` times per distance, then one entry per distance.
    oldest_first = F.reverse(F.array_sort(F.collect_list(F.struct("_age", "time_seconds"))))
    times = last.groupBy(*CAREER_KEYS).agg(
        F.transform(oldest_first, lambda swim: swim["time_seconds"]).alias("times")
    )
    return times.groupBy("SwimmerId").agg(F.collect_list(F.struct("stroke", "distance", "times")).alias("_swum"))


# The summary's names of the swimmer's attributes, in order, and the raw columns they come from.
SUMMARY_ATTRIBUTES = {
    "id": "SwimmerId", "name": "Name", "age": "Age", "gender": "Gender", "citizenship": "Citizenship",
    "birth_country": "Birth_Country", "residency_years": "Residency_Years",
    "approving_authority": "Approving_Authority", "criminal_record": "Criminal_Record",
    "is_disqualified": "Is_Disqualified", "vaccination_status": "Vaccination_Status", "sponsor": "Sponsor",
    "club": "Club", "region": "Region", "Birth_Date": "Birth_Date", "Education_Level": "Education_Level",
}


def rankings_summary(raw: DataFrame, length: int = HISTORY_LENGTH, tie: list[str] | None = None) -> DataFrame:
    """Every swimmer × stroke with counts of places 1 to 5 and the map distance → last times.

    The swimmer's attributes are those of the newest swim. The map holds all distances of the stroke, empty
    where none was swum.
    """
    attributes = F.struct(*[F.col(c).alias(a) for a, c in SUMMARY_ATTRIBUTES.items()])
    # The texts are grouped by before their greatest is taken: a hash table of the swimmers, where the greatest text among
    # all swims would have every task sort whole rows of its part of the input.
    dated = raw.groupBy(*SUMMARY_ATTRIBUTES.values()).agg(F.max(as_date("Competition_Date")).alias("swim_date"))
    newest = F.max(F.struct("swim_date", attributes.alias("attributes")))
    swimmers = dated.groupBy("SwimmerId").agg(newest.alias("newest")).select("newest.attributes.*")
    listed = F.create_map(
        *chain.from_iterable(
            (F.lit(name), F.array(*[F.lit(d) for d in metres])) for name, metres in STROKE_DISTANCES.items()
        )
    )
    strokes = F.array(*[F.lit(name) for name in STROKE_DISTANCES])
    counts = place_counts(raw, tie).withColumnRenamed("swimmer_id", "SwimmerId")
    counts = counts.filter(F.col("stroke").isin(*STROKE_DISTANCES)).groupBy("SwimmerId").agg(
        F.collect_list(F.struct("stroke", *[f"rank{k}_count" for k in RANKS])).alias("_counts")
    )
    # One row per swimmer is joined; the strokes come afterwards, so that no join sorts a swimmer's texts five times.
    joined = join_null_safe(swimmers.withColumn("SwimmerId", F.col("id")), counts, ["SwimmerId"], "left")
    joined = join_null_safe(joined, _histories(raw, length, tie), ["SwimmerId"], "left")
    joined = joined.withColumn("stroke", F.explode(strokes))

    def own(name: str) -> Column:
        return F.filter(name, lambda x: x["stroke"] == F.col("stroke"))

    count = F.get(own("_counts"), F.lit(0))
    distances = F.transform(own("_swum"), lambda x: F.struct(x["distance"], x["times"]))
    none = F.array().cast("array<double>")
    nothing = F.map_from_arrays(F.array().cast("array<int>"), F.array().cast("array<array<double>>"))
    swum = F.coalesce(F.map_from_entries(distances), nothing)
    metres = F.array_sort(F.array_union(listed[F.col("stroke")], F.map_keys(swum)))
    records = F.map_from_arrays(metres, F.transform(metres, lambda d: F.coalesce(F.try_element_at(swum, d), none)))
    return joined.select(
        *SUMMARY_ATTRIBUTES,
        F.col("stroke").alias("Stroke"),
        *[F.coalesce(count[f"rank{k}_count"], F.lit(0)).alias(f"Rank{k}_Count") for k in RANKS],
        records.alias("Historical_Records"),
    )


def as_results(raw: DataFrame, tie: list[str] | None = None) -> DataFrame:
    """Raw results with the computed columns filled in, as text: place, top-5 flag, best flag and history.

    The best flag and the history come from one pass over the careers. A record, once set, stays valid, so that
    flag is true throughout.
    """
    names = raw.columns
    placed = places(raw, tie).withColumn("Overall_Rank", F.col("place").cast("string")).select(*names)
    order = _oldest_first(raw, tie)
    career = running_min_and_list(
        _career(placed), CAREER_KEYS, order, "time_seconds", HISTORY_LENGTH, "best_so_far", "history"
    )
    return _best_flag(career).withColumns(
        {
            "Is_Personal_Best": F.initcap(F.col("is_personal_best").cast("string")),
            "Historical_Times": history_text("history"),
            "Is_Valid_Record": F.lit("True"),
        }
    ).select(*names)
