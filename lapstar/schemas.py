"""Table schemas, fixed value lists and report parameters."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# The header of a results file, in file order.
RAW_COLUMNS = [
    "SwimmerId", "Name", "Birth_Date", "Age", "Gender", "Citizenship", "Birth_Country", "Residency_Years",
    "Approving_Authority", "Education_Level", "Criminal_Record", "Is_Disqualified", "Vaccination_Status",
    "Sponsor", "Club", "Region", "Event", "Time", "Historical_Times", "Is_Personal_Best", "Is_Valid_Record",
    "Overall_Rank", "Top_5", "Competition_Date", "Competition_Level", "Competition_Competition_Id",
    "Competition_Country", "Competition_Region", "Competition_Pool_Type",
]

# The columns that dimensions and facts are made of.
USED_COLUMNS = [
    "SwimmerId", "Name", "Birth_Date", "Gender", "Citizenship", "Event", "Time", "Overall_Rank", "Age",
    "Competition_Competition_Id", "Competition_Date", "Competition_Country", "Competition_Level",
]

RAW = T.StructType([T.StructField(name, T.StringType()) for name in RAW_COLUMNS])

_KINDS = {
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
}


def _table(**columns: str) -> T.StructType:
    return T.StructType([T.StructField(name, _KINDS[kind]) for name, kind in columns.items()])


DIM_SWIMMER = _table(
    swimmer_sk="bigint",
    swimmer_id="string",
    name="string",
    birth_date="date",
    gender="string",
    nationality="string",
    is_current="boolean",
    valid_from="date",
    valid_to="date",
    version="int",
    created_at="timestamp",
    updated_at="timestamp",
)
DIM_EVENT = _table(event_sk="bigint", distance="int", stroke="string", course="string")
DIM_COMPETITION = _table(
    competition_sk="bigint",
    competition_id="string",
    competition_date="date",
    location_code="string",
    competition_name="string",
)
FACT_PERFORMANCE = _table(
    performance_id="bigint",
    swimmer_sk="bigint",
    event_sk="bigint",
    competition_sk="bigint",
    time_seconds="double",
    overall_rank="int",
    age="int",
)
FACT_RANKINGS = _table(
    ranking_id="bigint", swimmer_sk="bigint", event_sk="bigint", best_time="double", best_rank="int"
)

SWIMMER_ATTRIBUTES = ["name", "birth_date", "gender", "nationality"]
REQUIRED_SWIMMER_COLUMNS = ["SwimmerId", "Name", "Birth_Date", "Gender"]

# Length limits of the text columns, by table.
TEXT_LIMITS = {
    "dim_swimmer": {"swimmer_id": 50, "name": 255, "gender": 1, "nationality": 3},
    "dim_event": {"stroke": 50, "course": 50},
    "dim_competition": {"competition_id": 50, "location_code": 50, "competition_name": 255},
}

# Distances swum per stroke.
STROKE_DISTANCES = {
    "Butterfly": [50, 100, 200],
    "Freestyle": [50, 100, 200, 400, 800, 1500],
    "Backstroke": [50, 100, 200],
    "Breaststroke": [50, 100, 200],
    "Individual Medley": [200, 400],
}

# Most entries per event, by competition level.
ENTRY_CAPS = {"National": 60, "Province": 45, "Local": 35}

# Where a row was read: an order over these is stable, and separates even exact copies of a row.
SOURCE = ["source_file", "source_block"]
RAW_WITH_SOURCE = T.StructType(
    [*RAW, T.StructField(SOURCE[0], T.StringType()), T.StructField(SOURCE[1], T.LongType())]
)

# How many times a competitor's history keeps per event.
HISTORY_LENGTH = 50

CLUB_PLACEHOLDER = "Club data not available"
COURSE = "LCM"


def tie_columns(raw: DataFrame, tie: list[str] | None) -> list[str]:
    """Columns that settle ties: the given ones, else the source columns if the rows have them."""
    return tie if tie is not None else [c for c in SOURCE if c in raw.columns]


@dataclass(frozen=True)
class Params:
    """Gates and limits of the reports."""

    a_cut: float = 25.0
    b_cut: float = 30.0
    qualifying_from: float = 22.0
    qualifying_to: float = 50.0
    top_places: int = 5
    last_swims: int = 5
    min_wins: int = 3
    min_competitions: int = 50
    min_qualifying: int = 5
    min_age: int = 12


@dataclass(frozen=True)
class Warehouse:
    """The star schema as frames."""

    swimmers: DataFrame
    events: DataFrame
    competitions: DataFrame
    performance: DataFrame
    rankings: DataFrame
