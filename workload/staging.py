"""Shapes the driver's test tables into raw results: swimmer = customer, event = part, swim = line item.

The SQL text says what the rows are and is what the oracle runs. Spark makes the same rows from narrow ones: small tables are
joined to their like first, only what cannot be derived again is shuffled, and the place within a competition's event,
the one step that groups large shares of the rows, is the library's.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapstar.operators.scans import nulls_last, number_in_groups
from lapstar.plans.load import read_warehouse, run_load
from lapstar.schemas import RAW_COLUMNS, Params, Warehouse
from lapstar.session import new_path, save, shuffles_for
from lapstar.sources.files import write_results

AS_OF = "2018-06-30"
SRC = ["src_order", "src_line", "src_part", "src_supp", "src_price"]
GATES = Params(min_competitions=5, min_qualifying=2, min_wins=1)

SWIMS = """
WITH s AS (
  SELECT c_custkey AS k, c_nationkey AS nk, c_name, c_mktsegment,
         CAST((c_custkey * 37) % 9000 AS INT) AS off,
         CAST(floor((13329 - (c_custkey * 37) % 9000) / 365) AS INT) AS age,
         CASE WHEN c_custkey % 5 = 0 THEN 1 ELSE 0 END AS foreigner
  FROM {customer}),
j AS (
  SELECT s.*, l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_extendedprice, l.l_tax, l.l_returnflag,
         2000 + CAST(floor(l.l_extendedprice / 10) AS BIGINT) AS cs,
         CASE p.p_size % 4 WHEN 0 THEN '50m ' WHEN 1 THEN '100m ' WHEN 2 THEN '200m ' ELSE '400m ' END ||
         CASE p.p_type WHEN 'PROMO' THEN 'Butterfly' WHEN 'SMALL' THEN 'Backstroke' WHEN 'MEDIUM' THEN 'Breaststroke'
                       WHEN 'LARGE' THEN 'Individual Medley' ELSE 'Freestyle' END AS Event,
         CAST(date_trunc('month', o.o_orderdate) AS DATE) AS cdate,
         year(o.o_orderdate) * 100 + month(o.o_orderdate) AS ym,
         month(o.o_orderdate) AS mon
  FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey
       JOIN s ON o.o_custkey = s.k JOIN {part} p ON l.l_partkey = p.p_partkey),
t AS (
  SELECT j.*,
    CASE WHEN l_linenumber = 7 AND l_returnflag = 'R' THEN 'DNS'
         WHEN l_linenumber = 6 AND l_tax = 0 THEN NULL
         WHEN cs >= 6000 THEN CAST(CAST(floor(cs / 6000) AS BIGINT) AS STRING) || ':' ||
              lpad(CAST(CAST(floor((cs % 6000) / 100) AS BIGINT) AS STRING), 2, '0') || '.' || lpad(CAST(cs % 100 AS STRING), 2, '0')
         ELSE CAST(CAST(floor(cs / 100) AS BIGINT) AS STRING) || '.' || lpad(CAST(cs % 100 AS STRING), 2, '0') END AS Time,
    CASE WHEN (l_linenumber = 7 AND l_returnflag = 'R') OR (l_linenumber = 6 AND l_tax = 0) THEN NULL ELSE cs END AS tcs
  FROM j)"""

# Fixed value: the vaccination status that the eligibility rule looks for is 'Fully Vaccinated'.
PLACED = """,
r AS (
  SELECT t.*, CASE WHEN tcs IS NOT NULL THEN row_number() OVER (PARTITION BY ym, Event
     ORDER BY tcs ASC NULLS LAST, k, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) END AS place
  FROM t)"""

RESULTS = """
SELECT 'SWM' || lpad(CAST(k AS STRING), 9, '0') AS SwimmerId, c_name AS Name,
  CAST(DATE '1982-01-01' + off AS STRING) AS Birth_Date, CAST(age AS STRING) AS Age,
  CASE c_mktsegment WHEN 'BUILDING' THEN 'Women' WHEN 'MACHINERY' THEN 'Men' ELSE 'Other' END AS Gender,
  'N' || lpad(CAST(nk AS STRING), 2, '0') AS Citizenship,
  'N' || lpad(CAST((nk + foreigner) % 25 AS STRING), 2, '0') AS Birth_Country,
  CAST(CASE WHEN foreigner = 1 THEN k % 11 ELSE age END AS STRING) AS Residency_Years,
  CASE WHEN foreigner = 0 THEN NULL WHEN k % 3 = 0 THEN 'authority_0' WHEN k % 3 = 1 THEN 'authority_1' ELSE 'authority_2' END AS Approving_Authority,
  CASE WHEN age < 18 THEN 'High School' WHEN age < 25 THEN 'Bachelors' WHEN k % 10 < 3 THEN 'MBA' ELSE 'Bachelors' END AS Education_Level,
  CASE k % 4 WHEN 0 THEN 'record_0' WHEN 1 THEN 'record_1' WHEN 2 THEN 'record_2' ELSE 'record_3' END AS Criminal_Record,
  CASE WHEN k % 4 >= 2 THEN 'True' ELSE 'False' END AS Is_Disqualified,
  CASE k % 7 WHEN 0 THEN 'vaccination_0' WHEN 1 THEN 'vaccination_1' WHEN 2 THEN 'vaccination_2' ELSE 'Fully Vaccinated' END AS Vaccination_Status,
  CASE k % 5 WHEN 0 THEN 'sponsor_0' WHEN 1 THEN 'sponsor_1' WHEN 2 THEN 'sponsor_2' WHEN 3 THEN 'sponsor_3' ELSE 'sponsor_4' END AS Sponsor,
  'Club_R' || CAST(nk % 3 AS STRING) AS Club, 'R' || CAST(nk % 3 AS STRING) AS Region,
  Event, Time, CAST(NULL AS STRING) AS Historical_Times, CAST(NULL AS STRING) AS Is_Personal_Best, 'True' AS Is_Valid_Record,
  CAST(place AS STRING) AS Overall_Rank, CASE WHEN place <= 5 THEN 'Yes' ELSE 'No' END AS Top_5,
  CAST(cdate AS STRING) AS Competition_Date,
  CASE mon % 3 WHEN 0 THEN 'National' WHEN 1 THEN 'Province' ELSE 'Local' END AS Competition_Level,
  'C' || CAST(ym AS STRING) AS Competition_Competition_Id,
  'N' || lpad(CAST(ym % 25 AS STRING), 2, '0') AS Competition_Country, 'R' || CAST(ym % 3 AS STRING) AS Competition_Region,
  CASE mon % 3 WHEN 0 THEN '50m' ELSE '25m' END AS Competition_Pool_Type,
  l_orderkey AS src_order, l_linenumber AS src_line, l_partkey AS src_part, l_suppkey AS src_supp, l_extendedprice AS src_price
FROM {r}"""

# The swims of SWIMS in as few columns as they can be made from: orders meet customers and lines meet parts, then these two.
NARROW = """
SELECT e.c_custkey AS k, e.c_nationkey AS nk, e.c_name, e.c_mktsegment, e.ym, l.event_no, l.l_orderkey, l.l_linenumber,
  l.l_partkey, l.l_suppkey, l.l_extendedprice, l.missed,
  CASE WHEN l.missed = 0 THEN 2000 + CAST(floor(l.l_extendedprice / 10) AS BIGINT) END AS tcs
FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, p.event_no,
        CASE WHEN l_linenumber = 7 AND l_returnflag = 'R' THEN 2 WHEN l_linenumber = 6 AND l_tax = 0 THEN 1 ELSE 0 END AS missed
      FROM {lineitem} JOIN (
        SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN 0 WHEN 1 THEN 10 WHEN 2 THEN 20 ELSE 30 END +
          CASE p_type WHEN 'PROMO' THEN 0 WHEN 'SMALL' THEN 1 WHEN 'MEDIUM' THEN 2 WHEN 'LARGE' THEN 3 ELSE 4 END AS event_no
        FROM {part}) p ON l_partkey = p.p_partkey) l
  JOIN (SELECT o_orderkey, year(o_orderdate) * 100 + month(o_orderdate) AS ym, c_custkey, c_nationkey, c_name, c_mktsegment
        FROM {orders} JOIN {customer} ON o_custkey = c_custkey) e ON l.l_orderkey = e.o_orderkey"""

WIDE = """
SELECT r.*, CAST((k * 37) % 9000 AS INT) AS off, CAST(floor((13329 - (k * 37) % 9000) / 365) AS INT) AS age,
  CASE WHEN k % 5 = 0 THEN 1 ELSE 0 END AS foreigner, make_date(ym div 100, ym % 100, 1) AS cdate, ym % 100 AS mon,
  CASE event_no div 10 WHEN 0 THEN '50m ' WHEN 1 THEN '100m ' WHEN 2 THEN '200m ' ELSE '400m ' END ||
  CASE event_no % 10 WHEN 0 THEN 'Butterfly' WHEN 1 THEN 'Backstroke' WHEN 2 THEN 'Breaststroke'
                     WHEN 3 THEN 'Individual Medley' ELSE 'Freestyle' END AS Event,
  CASE WHEN missed = 2 THEN 'DNS'
       WHEN tcs >= 6000 THEN CAST(CAST(floor(tcs / 6000) AS BIGINT) AS STRING) || ':' ||
            lpad(CAST(CAST(floor((tcs % 6000) / 100) AS BIGINT) AS STRING), 2, '0') || '.' || lpad(CAST(tcs % 100 AS STRING), 2, '0')
       ELSE CAST(CAST(floor(tcs / 100) AS BIGINT) AS STRING) || '.' || lpad(CAST(tcs % 100 AS STRING), 2, '0') END AS Time
FROM {r} r"""

TABLES = ["customer", "orders", "lineitem", "part"]
STAGING_SQL = (SWIMS + PLACED + RESULTS).format(r="r", **{name: name for name in TABLES})

# Existing versions and the next feed of a dimension, from customer.
SCD_EXISTING = """
SELECT c_custkey AS k, c_name AS name, CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE c_nationkey END AS nat
FROM {customer} WHERE c_custkey % 7 <> 0"""
SCD_FEED = """
SELECT c_custkey AS k, c_name || CASE WHEN c_custkey % 13 = 0 THEN '_X' ELSE '' END AS name,
       CASE WHEN c_custkey % 19 = 0 THEN NULL WHEN c_custkey % 10 = 0 THEN (c_nationkey + 1) % 25 ELSE c_nationkey END AS nat
FROM {customer} WHERE c_custkey % 11 <> 0"""

_KEPT: dict[tuple[str, str, str], object] = {}


def once(spark: SparkSession, sf_dir: str, what: str, build):
    """Built once per application and data folder: stored tables, as a user of the reports has them."""
    key = (spark.sparkContext.applicationId, sf_dir, what)
    if key not in _KEPT:
        _KEPT[key] = build()
    return _KEPT[key]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw results with the ``src_*`` columns that identify a row; not stored."""
    tables = {name: table(spark, sf_dir, name) for name in TABLES}
    swims = spark.sql(NARROW, **tables)
    order = [*nulls_last("tcs"), "k", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
             "l_extendedprice"]
    placed = number_in_groups(swims, ["ym", "event_no"], order, "place")
    placed = placed.withColumn("place", F.when(F.col("tcs").isNotNull(), F.col("place")))
    return spark.sql(RESULTS, r=spark.sql(WIDE, r=placed))


def raw_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    def build() -> DataFrame:
        with shuffles_for(spark, table(spark, sf_dir, "lineitem").count()):
            return save(stage(spark, sf_dir), "raw")

    return once(spark, sf_dir, "raw", build)


def results_folder(spark: SparkSession, sf_dir: str) -> str:
    """The raw results as files."""

    def build() -> str:
        path = new_path(spark, "results")
        write_results(raw_results(spark, sf_dir), path, compression="gzip")
        return path

    return once(spark, sf_dir, "files", build)


def new_database(spark: SparkSession, label: str = "lapstar") -> str:
    """An empty database in the shared folder."""
    path = new_path(spark, label)
    name = path.rsplit("/", 1)[1].replace("-", "_")
    spark.sql(f"CREATE DATABASE {name} LOCATION '{path}'")
    return name


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The star schema of the raw results, loaded once."""

    def build() -> str:
        database = new_database(spark, "warehouse")
        run_load(spark, raw_results(spark, sf_dir), database, "initial", AS_OF, SRC)
        return database

    return read_warehouse(spark, once(spark, sf_dir, "warehouse", build))


def scd_pair(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    customer = table(spark, sf_dir, "customer")
    existing = spark.sql(SCD_EXISTING, customer=customer).withColumns(
        {
            "is_current": F.lit(True),
            "valid_from": F.lit("2000-01-01").cast("date"),
            "valid_to": F.lit(None).cast("date"),
            "version": F.lit(1),
        }
    )
    return existing, spark.sql(SCD_FEED, customer=customer)


assert len(RAW_COLUMNS) == 29
