import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from lapstar import functions as fn
from lapstar.schemas import Params


def evaluate(spark, column, values, kind):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r.y for r in rows.select("i", column.alias("y")).orderBy("i").collect()]


TIMES = {
    "25.30": 25.3, "1:02.33": 62.33, "1:00:01.5": 3601.5, "1:60.00": 120.0, " 12.5 ": 12.5, "+3.": 3.0, ".5": 0.5,
    None: None, "": None, "DNS": None, "1d": None, "inf": None, "nan": None, "1:2:3:4": None, "1e3": None,
    "1_0": None, "1:": None, ":5": None, "1:DNS": None,
}


def test_parse_time(spark):
    assert evaluate(spark, fn.parse_time("x"), list(TIMES), "string") == list(TIMES.values())


def test_parse_time_in_sql_text_agrees(spark):
    fn.register(spark)
    assert evaluate(spark, F.expr("parse_time(x)"), list(TIMES), "string") == list(TIMES.values())


def python_seconds(text):
    parts = text.split(":")
    if len(parts) > 3 or not all(re.fullmatch(r"[ \t]*[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)[ \t]*", p) for p in parts):
        return None
    values = [float(p) for p in parts]
    weights = [3600, 60, 1][-len(values):]
    return sum(v * w for v, w in zip(values[:-1], weights)) + values[-1] if len(values) > 1 else values[0]


def test_parse_time_on_random_text(spark):
    rng = random.Random(11)
    texts = ["".join(rng.choice("0123456789.: +-e") for _ in range(rng.randrange(9))) for _ in range(3000)]
    texts += [f"{rng.randrange(3)}:{rng.randrange(60):02}.{rng.randrange(100):02}" for _ in range(500)]
    expected = [python_seconds(t) for t in texts]
    assert sum(e is not None for e in expected) > 800
    assert evaluate(spark, fn.parse_time("x"), texts, "string") == expected


def test_format_time(spark):
    times = {25.3: "25.30", 62.33: "1:02.33", 59.996: "1:00.00", 119.996: "2:00.00", 0.05: "0.05", 3601.5: "60:01.50"}
    assert evaluate(spark, fn.format_time("x"), [*times, None], "double") == [*times.values(), None]


def test_format_then_parse_gives_every_hundredth_back(spark):
    times = spark.range(0, 20_000).select((F.col("id") / 100).alias("x"))
    again = fn.parse_time(fn.format_time("x"))
    assert times.filter((F.abs(again - F.col("x")) > 1e-9) | (fn.format_time(again) != fn.format_time("x"))).isEmpty()


EVENTS = {
    "50m Butterfly": (50, "Butterfly"),
    "200m Individual Medley": (200, "Individual Medley"),
    "Relay": (None, "Relay"),
    "4x100m 50m Free": (100, "4xFree"),
    None: (None, None),
}


def test_events(spark):
    assert evaluate(spark, fn.distance("x"), list(EVENTS), "string") == [d for d, _ in EVENTS.values()]
    assert evaluate(spark, fn.stroke("x"), list(EVENTS), "string") == [s for _, s in EVENTS.values()]
    assert evaluate(spark, fn.event_label(F.lit(50), "x"), ["Free"], "string") == ["50m Free"]


AGES = [
    ("2000-02-29", "2023-02-28", 22), ("2000-02-29", "2023-03-01", 23), ("2000-02-29", "2024-02-29", 24),
    ("2000-12-31", "2018-06-30", 17), ("2000-06-30", "2018-06-30", 18), (None, "2018-06-30", None),
]


@pytest.mark.parametrize("birth, on, age", AGES)
def test_age_years(spark, birth, on, age):
    fn.register(spark)
    assert evaluate(spark, fn.age_years(fn.as_date("x"), on), [birth], "string") == [age]
    assert evaluate(spark, F.expr(f"age_years(date(x), date'{on}')"), [birth], "string") == [age]


def test_age_in_spans_of_365_days(spark):
    birth = [dt.date(2000, 7, 3), dt.date(2017, 6, 30), None]
    assert evaluate(spark, fn.age_days365("x", "2018-06-30"), birth, "date") == [18, 1, None]


def test_groups_and_labels(spark):
    assert evaluate(spark, fn.age_group("x"), [12, 14, 15, 17, 18, 40], "int") == [
        "12-14", "12-14", "15-17", "15-17", "17+", "17+"]
    assert evaluate(spark, fn.education_band("x"), [17, 18, 24, 25, None], "int") == [
        "High School", "Bachelors", "Bachelors", None, None]
    assert evaluate(spark, fn.cut_label("x"), [25.0, 25.01, 30.0, 30.01, None], "double") == [
        "A Cut", "B Cut", "B Cut", "Not Qualified", "Not Qualified"]
    assert evaluate(spark, fn.cut_label("x", Params(a_cut=50)), [40.0], "double") == ["A Cut"]
    assert evaluate(spark, fn.gender_code("x"), ["Women", "Men", "Other", None], "string") == ["F", "M", "U", "U"]
    assert evaluate(spark, fn.top_flag("x"), [1, 5, 6], "int") == ["Yes", "Yes", "No"]


def test_casts_never_raise(spark):
    assert evaluate(spark, fn.as_int("x"), ["7", "3.0", " 4 ", "x", "", None, "99999999999"], "string") == [
        7, 3, 4, None, None, None, None]
    assert evaluate(spark, fn.as_date("x"), ["2025-12-03 19:43:00.1", "2025-12-03", "soon", None], "string") == [
        dt.date(2025, 12, 3), dt.date(2025, 12, 3), None, None]


def test_history_text_and_back(spark):
    texts = ["['25.30', '1:02.33']", "[]", None]
    assert evaluate(spark, fn.history_array("x"), texts, "string") == [[25.3, 62.33], [], None]
    assert evaluate(spark, fn.history_text(fn.history_array("x")), texts, "string") == texts


def test_competition_code_and_file_name(spark):
    codes = evaluate(spark, fn.competition_code("x", F.lit(7)), ["National", "Local"], "string")
    assert codes == ["NAT_007", "LOC_007"]
    assert evaluate(spark, fn.competition_code("x", F.lit(1234)), ["Province"], "string") == ["PRO_1234"]
    assert evaluate(spark, fn.file_name("x", F.lit("NAT_001")), ["2025-12-03 19:43:00.1"], "string") == [
        "20251203_NAT_001_results.csv"]


def test_parse_results_types_in_place(raw_frame):
    typed = fn.parse_results(raw_frame([{"Age": "12", "Gender": "Men", "Birth_Date": "2000-01-01"}]))
    kinds = dict(typed.dtypes)
    assert len(kinds) == 29
    assert (kinds["age"], kinds["gender"], kinds["birth_date"], kinds["competition_date"]) == (
        "int", "string", "date", "date")
