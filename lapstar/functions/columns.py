"""Column expressions. All stay in the JVM: no Python worker touches a row."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lapstar.schemas import Params

__all__ = [
    "age_days365", "age_group", "age_years", "as_date", "as_int", "competition_code", "cut_label", "day", "distance",
    "education_band", "event_label", "file_name", "format_time", "gender_code", "history_array", "history_text",
    "parse_results", "parse_time", "register", "stroke", "top_flag",
]

_PART = r"\s*[+-]?(?:\d+\.?\d*|\.\d+)\s*"
TIME_PATTERN = rf"^{_PART}(?::{_PART}){{0,2}}$"
INT_PATTERN = r"^\s*([+-]?\d+)(?:\.\d*)?\s*$"


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def day(value: dt.date | str | Column | None) -> Column:
    """A date literal; today's date when no value is given."""
    if value is None:
        return F.current_date()
    if isinstance(value, Column):
        return value.cast("date")
    return F.lit(str(value)).cast("date")


def as_date(text: Column | str) -> Column:
    """Date of a text, null when it is no date; a time of day is cut off."""
    return _column(text).try_cast("date")


def as_int(text: Column | str) -> Column:
    """Whole number of a text, null when it is none; decimals are cut off (``'3.0'`` is 3)."""
    text = _column(text)
    return F.coalesce(text.try_cast("int"), F.regexp_extract(text, INT_PATTERN, 1).try_cast("int"))


def gender_code(text: Column | str) -> Column:
    text = _column(text)
    return F.when(text == "Women", "F").when(text == "Men", "M").otherwise("U")


def distance(event: Column | str) -> Column:
    """Metres in an event label such as ``50m Butterfly``; null when it has none."""
    return F.regexp_extract(_column(event), r"(\d+)m", 1).try_cast("int")


def stroke(event: Column | str) -> Column:
    """An event label without any of its distances."""
    return F.regexp_replace(_column(event), r"\d+m\s*", "")


def event_label(metres: Column | str, name: Column | str) -> Column:
    return F.concat(_column(metres).cast("string"), F.lit("m "), _column(name))


def parse_time(text: Column | str) -> Column:
    """Seconds of ``SS.ss``, ``M:SS.ss`` or ``H:MM:SS.ss``; null for anything else."""
    text = _column(text)
    parts = F.split(text, ":")

    def part(index: int) -> Column:
        return F.get(parts, F.lit(index)).try_cast("double")

    count = F.size(parts)
    return F.when(
        text.rlike(TIME_PATTERN),
        F.when(count == 1, part(0))
        .when(count == 2, part(0) * 60 + part(1))
        .otherwise(part(0) * 3600 + part(1) * 60 + part(2)),
    )


def format_time(seconds: Column | str) -> Column:
    """Text ``SS.ss`` or ``M:SS.ss``, rounded once, in hundredths, so 119.996 gives ``2:00.00``."""
    hundredths = F.round(_column(seconds) * 100).cast("bigint")
    minutes = F.floor(hundredths / 6000).cast("bigint")
    rest = hundredths % 6000
    whole = F.floor(rest / 100).cast("string")
    decimals = F.lpad((rest % 100).cast("string"), 2, "0")
    return F.when(
        minutes > 0,
        F.concat(minutes.cast("string"), F.lit(":"), F.lpad(whole, 2, "0"), F.lit("."), decimals),
    ).otherwise(F.concat(whole, F.lit("."), decimals))


def age_years(birth: Column | str, as_of: dt.date | str | Column | None = None) -> Column:
    """Completed years of life on a day."""
    birth, on = _column(birth), day(as_of)

    def in_year(date: Column) -> Column:
        return F.month(date) * 100 + F.dayofmonth(date)

    return F.year(on) - F.year(birth) - (in_year(on) < in_year(birth)).cast("int")


def age_days365(birth: Column | str, as_of: dt.date | str | Column | None = None) -> Column:
    """Age as whole spans of 365 days; differs from ``age_years`` near birthdays."""
    return F.floor(F.datediff(day(as_of), _column(birth)) / 365).cast("int")


def age_group(age: Column | str) -> Column:
    age = _column(age)
    return F.when(age.between(12, 14), "12-14").when(age.between(15, 17), "15-17").otherwise("17+")


def education_band(age: Column | str) -> Column:
    """School level where age decides it; null from 25 on, where it does not."""
    age = _column(age)
    return F.when(age < 18, "High School").when(age < 25, "Bachelors")


def cut_label(best: Column | str, params: Params = Params()) -> Column:
    best = _column(best)
    return F.when(best <= params.a_cut, "A Cut").when(best <= params.b_cut, "B Cut").otherwise("Not Qualified")


def top_flag(place: Column | str, places: int = 5) -> Column:
    return F.when(_column(place) <= places, "Yes").otherwise("No")


def history_array(text: Column | str) -> Column:
    """Seconds of a printed list such as ``['25.30', '1:02.33']``."""
    items = F.from_json(F.translate(_column(text), "'", '"'), "array<string>")
    return F.transform(items, parse_time)


def history_text(times: Column | str) -> Column:
    """The printed list of an array of seconds."""
    items = F.transform(_column(times), lambda t: F.concat(F.lit("'"), format_time(t), F.lit("'")))
    return F.concat(F.lit("["), F.array_join(items, ", "), F.lit("]"))


def competition_code(level: Column | str, number: Column | str) -> Column:
    """Id of a competition, such as ``NAT_001`` for the first national one."""
    return F.format_string("%s_%03d", F.upper(F.substring(_column(level), 1, 3)), _column(number))


def file_name(date: Column | str, competition_id: Column | str) -> Column:
    """Name of the results file of a competition."""
    return F.concat_ws(
        "_", F.date_format(as_date(_column(date)), "yyyyMMdd"), _column(competition_id), F.lit("results.csv")
    )


def parse_results(raw: DataFrame) -> DataFrame:
    """The results with their dates, whole numbers and gender typed in place of the text."""
    return raw.withColumns(
        {
            "birth_date": as_date("Birth_Date"),
            "age": as_int("Age"),
            "gender": gender_code("Gender"),
            "overall_rank": as_int("Overall_Rank"),
            "competition_date": as_date("Competition_Date"),
        }
    )


# The same expressions for users of SQL text; the arguments are typed by the signature.
SQL_FUNCTIONS = {
    "parse_time(t STRING) RETURNS DOUBLE": rf"""CASE WHEN t RLIKE r'{TIME_PATTERN}' THEN CASE size(split(t, ':'))
        WHEN 1 THEN try_cast(t AS DOUBLE)
        WHEN 2 THEN try_cast(get(split(t, ':'), 0) AS DOUBLE) * 60 + try_cast(get(split(t, ':'), 1) AS DOUBLE)
        ELSE try_cast(get(split(t, ':'), 0) AS DOUBLE) * 3600 + try_cast(get(split(t, ':'), 1) AS DOUBLE) * 60
             + try_cast(get(split(t, ':'), 2) AS DOUBLE) END END""",
    "age_years(b DATE, d DATE) RETURNS INT": """year(d) - year(b)
        - CAST(month(d) * 100 + day(d) < month(b) * 100 + day(b) AS INT)""",
}


def register(spark: SparkSession) -> None:
    """Make ``parse_time`` and ``age_years`` callable from SQL text in this session."""
    for signature, body in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")
