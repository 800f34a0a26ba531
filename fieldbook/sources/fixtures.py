"""Survey-shaped fixture views derived from the TPC-H-style test tables.

The raw tables have unique keys and no NULLs, so these views plant the row
cases the jobs must handle (NULL phones, shared phones, padded names, blank
statuses, duplicate dictionary keys, dates near midnight, ...). Every view is
a projection of ``customer`` (joined to ``nation``/``region`` where noted),
so it grows with the scale factor.

Each view is defined once as SQL expression text. Spark applies it with
``selectExpr``; the DuckDB oracle uses the same text as leading CTEs, so both
engines see identical rows.

The columns beyond the planted set (origin city, monthly money, employees,
digital payments, smartphone use, enumerator, baseline expenses/profits, the
raw baseline names) feed report panels that have no other input here.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BASE_EXPRS = [
    "c_custkey AS k", "c_name AS nm", "c_nationkey AS nk", "c_acctbal AS bal", "c_mktsegment AS seg",
    "CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 10 = 1 THEN 9000000000 + c_custkey - 1 "
    "ELSE 9000000000 + c_custkey END AS ph",
]

ROSTER_EXPRS = [
    "CAST(k AS STRING) AS roster_no", "CAST(ph AS DOUBLE) AS phone_number", "nm AS roster_name",
    "CASE k % 8 WHEN 0 THEN 'Active' WHEN 1 THEN 'ACTIVE' WHEN 2 THEN 'Inactive' WHEN 3 THEN 'Duplicate' "
    "WHEN 4 THEN 'Missing' WHEN 5 THEN 'Not Located' WHEN 6 THEN 'Dropped' ELSE NULL END AS final_status",
]

# leaves people out of the submissions, so that some of the roster were never met
CONTACT_FILTER = "k % 5 <> 4"
CONTACT_EXPRS = [
    "'u' || CAST(CASE WHEN k % 50 = 1 THEN k - 1 ELSE k END AS STRING) AS uuid",
    "CAST(k AS STRING) AS submission_no",
    "CASE WHEN k % 12 = 0 THEN ' ' || nm || ' ' WHEN k % 17 = 0 THEN 'x' || nm ELSE nm END AS contact_name",
    "CASE WHEN k % 19 = 0 THEN 'n/a' WHEN k % 7 = 3 THEN CAST(9100000000 + k AS STRING) "
    "ELSE CAST(ph AS STRING) END AS phone_text",
    "CASE WHEN k % 7 = 3 THEN 'new' WHEN k % 23 = 0 THEN NULL ELSE '' END AS data_status",
    "CASE WHEN k % 9 = 0 THEN 'no' WHEN k % 31 = 0 THEN NULL WHEN k % 37 = 0 THEN 'unsure' "
    "ELSE 'yes' END AS located",
    "CASE WHEN k % 10 = 5 THEN '2024-12-01T03:00:00.000+05:30' WHEN k % 2 = 0 THEN "
    "'2024-11-20T10:15:00.000+05:30' ELSE '2024-12-05T09:00:00.000+05:30' END AS start_ts",
    "CASE WHEN k % 29 = 0 THEN NULL WHEN k % 4 = 0 THEN 'male' ELSE 'female' END AS gender",
    "CASE WHEN k % 47 = 0 THEN NULL ELSE CAST(20 + k % 41 AS DOUBLE) END AS age",
    "CASE WHEN k % 43 = 0 THEN NULL WHEN k % 6 = 0 THEN 'collective' ELSE 'individual' END AS ownership",
    "CASE WHEN k % 5 = 3 THEN NULL WHEN k % 6 = 1 THEN 'mobile_cart' WHEN k % 5 = 0 THEN 'home' "
    "ELSE 'shop' END AS facility_type",
    "CASE k % 6 WHEN 0 THEN ' ' || seg WHEN 1 THEN seg || '  store' WHEN 2 THEN seg || '  a  b' "
    "WHEN 3 THEN '' WHEN 4 THEN NULL ELSE seg END AS business_type",
    "CASE WHEN k % 3 = 0 THEN NULL ELSE CAST(100 * (k % 27) AS DOUBLE) END AS daily_income",
    "CASE WHEN k % 3 = 0 OR k % 8 = 1 THEN NULL ELSE CAST(50 * (k % 31) AS DOUBLE) END AS daily_expenses",
    "CASE WHEN k % 3 = 0 THEN NULL ELSE CAST(100 * (k % 27) - 50 * (k % 31) AS DOUBLE) END AS daily_profits",
    "CASE WHEN k % 14 = 0 THEN NULL WHEN k % 3 = 1 THEN 'no' ELSE 'yes' END AS bank_account",
    "CASE k % 4 WHEN 0 THEN 'yes' WHEN 1 THEN 'no' WHEN 2 THEN 'shared' ELSE NULL END AS smartphone_access",
    "CASE k % 6 WHEN 0 THEN '10th' WHEN 1 THEN '8th' WHEN 2 THEN 'PUC' WHEN 3 THEN 'Degree' "
    "WHEN 4 THEN 'unlisted' ELSE NULL END AS education_level",
    "CAST(1 + k % 7 AS DOUBLE) AS family_size",
    # extension columns
    "CASE WHEN k % 13 = 0 THEN NULL WHEN k % 4 = 1 THEN ' ' || n_name || '  ' "
    "WHEN k % 4 = 2 THEN replace(n_name, ' ', '  ') ELSE n_name END AS origin_city",
    "CASE WHEN k % 3 = 2 THEN NULL ELSE CAST(1000 * (k % 29) AS DOUBLE) END AS monthly_income",
    "CASE WHEN k % 3 = 2 OR k % 8 = 3 THEN NULL ELSE CAST(400 * (k % 37) AS DOUBLE) END AS monthly_expenses",
    "CASE WHEN k % 3 = 2 THEN NULL ELSE CAST(1000 * (k % 29) - 400 * (k % 37) AS DOUBLE) END AS monthly_profits",
    "CASE k % 5 WHEN 0 THEN 'no' WHEN 1 THEN NULL ELSE 'yes' END AS digital_payments",
    "CASE WHEN k % 4 = 1 THEN 'no' WHEN k % 9 = 4 THEN NULL ELSE 'yes' END AS smartphone_usability",
    "CASE WHEN k % 13 = 0 THEN NULL ELSE CAST(k % 4 AS DOUBLE) END AS total_employees",
    "CASE WHEN k % 13 = 0 THEN NULL ELSE CAST(k % 3 AS DOUBLE) END AS total_family_employees",
    "CASE WHEN k % 17 = 5 THEN NULL ELSE CAST(k % 5 AS DOUBLE) END AS total_children",
    "CAST(1 + k % 3 AS DOUBLE) AS total_earning_members",
    "'enumerator_' || CAST(k % 7 AS STRING) AS enumerator_name",
    # the rest of the form: text as people type it, with line breaks, quotes and commas
    "CASE WHEN k % 2 = 0 THEN '2024-11-20T10:45:00.000+05:30' ELSE '2024-12-05T09:30:00.000+05:30' END AS end_ts",
    "'user_' || CAST(k % 3 AS STRING) AS username",
    "'photo_' || CAST(k AS STRING) || '.jpg' AS photograph",
    "'/media/photo_' || CAST(k AS STRING) || '.jpg' AS photograph_url",
    "CASE WHEN k % 5 = 2 THEN NULL WHEN k % 5 = 1 THEN nm || ', \"the shop\"' ELSE nm || ' shop' END AS shop_name",
    "CASE WHEN k % 6 = 5 THEN NULL ELSE CAST(12 + k % 5 AS STRING) || '.5 77.5 0 0' END AS shop_location",
    "CASE WHEN k % 6 = 5 THEN NULL ELSE CAST(12 + k % 5 AS DOUBLE) END AS shop_latitude",
    "CASE WHEN k % 6 = 5 THEN NULL ELSE CAST(77 + k % 3 AS DOUBLE) END AS shop_longitude",
    "CASE WHEN k % 6 = 5 THEN NULL ELSE CAST(900 + k % 7 AS DOUBLE) END AS shop_altitude",
    "CASE WHEN k % 6 = 5 THEN NULL ELSE CAST(k % 20 AS DOUBLE) END AS shop_precision",
    "CASE k % 7 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN ' market  road ' WHEN 3 THEN 'lake side' "
    "WHEN 4 THEN 'old  town' WHEN 5 THEN 'unknown' ELSE 'market road' END AS locality",
    "'shop_' || CAST(k AS STRING) || '.jpg' AS business_photograph",
    "'/media/shop_' || CAST(k AS STRING) || '.jpg' AS business_photograph_url",
    "CASE WHEN k % 4 = 1 THEN 'sells \"this\", and' || chr(10) || 'that' WHEN k % 4 = 2 THEN NULL ELSE 'one line' END "
    "AS business_details",
    "CASE WHEN k % 6 = 1 THEN 'cart, with roof' ELSE NULL END AS facility_type_other",
    "CASE k % 3 WHEN 0 THEN 'mon tue wed' WHEN 1 THEN 'all' ELSE NULL END AS working_days",
    "CASE WHEN k % 4 = 3 THEN 'first line' || chr(10) || chr(10) || 'third line' ELSE '' END AS household_details",
    "CASE WHEN k % 9 = 2 THEN 'see \"notes\"' ELSE NULL END AS other_details",
    "'2024-12-05T10:00:0' || CAST(k % 10 AS STRING) AS submission_time",
    "CASE WHEN k % 8 = 0 THEN 'approved' ELSE NULL END AS validation_status",
    "CASE WHEN k % 16 = 3 THEN 'called, twice' ELSE NULL END AS notes",
    "'submitted_via_web' AS form_status", "'user_' || CAST(k % 3 AS STRING) AS submitted_by",
    "'v' || CAST(1 + k % 2 AS STRING) AS form_version", "CAST(NULL AS STRING) AS tags", "CAST(k AS DOUBLE) AS form_index",
]

DICTIONARY_SQL = (
    "SELECT * FROM (VALUES (0, 'BUILDING', 'Construction'), (1, 'BUILDING', 'Building (dup)'), "
    "(2, 'FURNITURE', 'Furniture'), (3, 'MACHINERY', NULL), (4, 'MACHINERY', 'Machines'), "
    "(5, 'BUILDING store', 'Construction'), (6, '', 'blank')) AS t(ord, business_type, business_type_clean)"
)

EDUCATION_DICTIONARY_SQL = (
    "SELECT * FROM (VALUES (0, '10th', '10th'), (1, '8th', '8th'), (2, 'PUC', 'PUC'), "
    "(3, 'Degree', 'Degree'), (4, 'unlisted', 'CA'), (5, 'Degree', 'Graduate')) "
    "AS t(ord, education_level, education_level_clean)"
)

LOCALITY_DICTIONARY_SQL = (
    "SELECT * FROM (VALUES (0, 'market road', 'Market Road'), (1, 'old town', 'Old Town'), "
    "(2, 'market road', 'Market Rd (dup)'), (3, 'lake side', NULL), (4, '', 'blank')) AS t(ord, locality, locality_clean)"
)

ORIGIN_DICTIONARY_EXPRS = [
    "n_nationkey AS ord", "n_name AS origin_city", "lower(n_name) AS origin_city_clean",
    "r_name AS origin_region_clean",
]
# leaves nations out of the dictionary, so that some lookups find nothing
ORIGIN_DICTIONARY_FILTER = "n_nationkey % 6 <> 5"

# leaves people out of the registry, so that some get no id
ID_MASTER_FILTER = "k % 4 <> 0"
ID_MASTER_EXPRS = [
    "CAST(ph AS DOUBLE) AS phone_number", "nm AS contact_name",
    "'M' || lpad(CAST(k AS STRING), 6, '0') AS member_id",
]
# people listed twice, with two ids: lookups by them give two rows
ID_MASTER_TWICE_FILTER = "k % 90 = 7"
ID_MASTER_TWICE_EXPRS = [
    "CAST(ph AS DOUBLE) AS phone_number", "nm AS contact_name",
    "'D' || lpad(CAST(k AS STRING), 6, '0') AS member_id",
]
ID_MASTER_NULL_ROW = ("SELECT CAST(NULL AS DOUBLE) AS phone_number, CAST(NULL AS STRING) AS contact_name, "
                      "CAST(NULL AS STRING) AS member_id")

# leaves people out of the baseline, so that both surveys have rows without a partner
BASELINE_FILTER = "k % 3 <> 1"
BASELINE_EXPRS = [
    "CASE WHEN k % 53 = 0 THEN NULL ELSE 'M' || lpad(CAST(k AS STRING), 6, '0') END AS member_id",
    "CASE WHEN k % 15 = 0 THEN lower(nm) ELSE nm END AS member_name",
    "CAST(CASE WHEN k % 16 = 0 THEN NULL WHEN k % 18 = 0 THEN 9999999999 ELSE ph END AS DOUBLE) AS phone_number",
    "CASE WHEN k % 10 = 3 THEN 'refused' ELSE NULL END AS visit_status",
    "seg AS type_b1",
    "CASE WHEN k % 3 = 0 THEN NULL ELSE ' ' || seg || '  store' END AS type_b2",
    "CASE WHEN k % 7 = 0 THEN 'MACHINERY' ELSE NULL END AS type_b3",
    "CASE WHEN k % 20 = 0 THEN NULL ELSE bal END AS b1_total_rev",
    "CASE WHEN k % 3 = 0 OR k % 20 = 0 THEN NULL ELSE bal / 2 END AS b2_total_rev",
    "CASE WHEN k % 7 = 0 AND k % 20 <> 0 THEN CAST(10 AS DOUBLE) ELSE NULL END AS b3_total_rev",
    # extension columns
    "CASE WHEN k % 20 = 0 THEN NULL ELSE CAST(10 * (k % 50) AS DOUBLE) END AS b1_total_exp",
    "CASE WHEN k % 3 = 0 OR k % 20 = 0 THEN NULL ELSE CAST(5 * (k % 40) AS DOUBLE) END AS b2_total_exp",
    "CASE WHEN k % 7 = 0 AND k % 20 <> 0 THEN CAST(4 AS DOUBLE) ELSE NULL END AS b3_total_exp",
    "CASE WHEN k % 20 = 0 THEN NULL ELSE bal - 10 * (k % 50) END AS b1_total_prof",
    "CASE WHEN k % 3 = 0 OR k % 20 = 0 THEN NULL ELSE bal / 2 - 5 * (k % 40) END AS b2_total_prof",
    "CASE WHEN k % 7 = 0 AND k % 20 <> 0 THEN CAST(6 AS DOUBLE) ELSE NULL END AS b3_total_prof",
    "CASE WHEN k % 4 = 0 THEN NULL ELSE CAST(k % 3 AS DOUBLE) END AS current_loan_count",
    "'enumerator_' || CAST(k % 7 AS STRING) AS enumerator_name",
    "CAST(12 - k % 5 AS DOUBLE) AS time_share_b1",
    "CASE WHEN k % 3 = 0 THEN NULL ELSE CAST(k % 5 AS DOUBLE) END AS time_share_b2",
    "CASE WHEN k % 7 = 0 THEN CAST(k % 2 AS DOUBLE) ELSE NULL END AS time_share_b3",
    "CASE WHEN k % 3 = 0 THEN 'no' ELSE 'yes' END AS second_business",
    "CASE WHEN k % 7 = 0 THEN 'yes' ELSE 'no' END AS third_business",
    "CASE k % 4 WHEN 0 THEN 'own' WHEN 1 THEN NULL ELSE 'rent' END AS house_ownership",
    "CASE WHEN k % 2 = 0 THEN 'brick' ELSE 'sheet' END AS house_type",
    "CASE k % 5 WHEN 0 THEN 'two wheeler' WHEN 1 THEN 'none' ELSE NULL END AS vehicle_type",
    "CASE WHEN k % 17 = 5 THEN NULL ELSE CAST(k % 5 AS DOUBLE) END AS total_children",
    "CASE WHEN k % 17 = 5 THEN NULL ELSE CAST(k % 3 AS DOUBLE) END AS total_children_school",
]

# A programme in which one phone holds a third of all submissions (one per order).
HOT_ROSTER_EXPRS = [
    "CAST(c_custkey AS STRING) AS roster_no", "CAST(9000000000 + c_custkey AS DOUBLE) AS phone_number",
    "c_name AS roster_name", "CASE WHEN c_custkey % 8 = 2 THEN 'Inactive' ELSE 'Active' END AS final_status",
]
HOT_CONTACT_EXPRS = [
    "CAST(o_orderkey AS STRING) AS submission_no", "'Customer#' || lpad(CAST(o_custkey AS STRING), 9, '0') AS contact_name",
    "CASE WHEN o_orderkey % 3 = 0 THEN '9000000001' ELSE CAST(9000000000 + o_custkey AS STRING) END AS phone_text",
    "CASE WHEN o_orderkey % 7 = 3 THEN 'new' ELSE '' END AS data_status", "'yes' AS located",
]

# The raw baseline export: form-group codes inside the money column names and
# layout columns (header / note / info) that tidying drops.
BASELINE_RAW_EXPRS = [
    "member_id", "member_name", "phone_number", "visit_status", "type_b1", "type_b2", "type_b3",
    "b1_total_rev AS group_gn69x50_total", "b1_total_exp AS group_cj4oj86_total",
    "b2_total_rev AS group_wb4eu10_total", "b2_total_exp AS group_ub0yl99_total",
    "b3_total_rev AS group_ff57r52_total", "b3_total_exp AS group_xp4ro84_total",
    "'section' AS intro_header", "'consent given' AS consent_note", "CAST(NULL AS STRING) AS gps_info",
]


def _select(exprs: list[str]) -> str:
    return ", ".join(exprs)


def fixture_ctes() -> str:
    """All fixture views as a ``WITH`` list body for the DuckDB oracle."""
    return ",\n".join([
        f"fx_base AS (SELECT {_select(BASE_EXPRS)} FROM customer)",
        f"fx_roster AS (SELECT {_select(ROSTER_EXPRS)} FROM fx_base)",
        f"fx_contact AS (SELECT {_select(CONTACT_EXPRS)} FROM fx_base LEFT JOIN nation ON n_nationkey = nk "
        f"WHERE {CONTACT_FILTER})",
        f"fx_hot_roster AS (SELECT {_select(HOT_ROSTER_EXPRS)} FROM customer)",
        f"fx_hot_contact AS (SELECT {_select(HOT_CONTACT_EXPRS)} FROM orders)",
        f"fx_dictionary AS ({DICTIONARY_SQL})",
        f"fx_locality_dictionary AS ({LOCALITY_DICTIONARY_SQL})",
        f"fx_education_dictionary AS ({EDUCATION_DICTIONARY_SQL})",
        f"fx_origin_dictionary AS (SELECT {_select(ORIGIN_DICTIONARY_EXPRS)} FROM nation "
        f"JOIN region ON n_regionkey = r_regionkey WHERE {ORIGIN_DICTIONARY_FILTER})",
        f"fx_id_master AS (SELECT {_select(ID_MASTER_EXPRS)} FROM fx_base WHERE {ID_MASTER_FILTER} "
        f"UNION ALL SELECT {_select(ID_MASTER_TWICE_EXPRS)} FROM fx_base WHERE {ID_MASTER_TWICE_FILTER} "
        f"UNION ALL {ID_MASTER_NULL_ROW})",
        f"fx_baseline AS (SELECT {_select(BASELINE_EXPRS)} FROM fx_base WHERE {BASELINE_FILTER})",
        f"fx_baseline_raw AS (SELECT {_select(BASELINE_RAW_EXPRS)} FROM fx_baseline)",
    ])


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table, with its declared schema when known (no footer-inference job)."""
    from fieldbook.sources.schemas import INPUT_TABLES

    reader = spark.read
    if name in INPUT_TABLES:
        reader = reader.schema(INPUT_TABLES[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@dataclass
class Fixtures:
    """Fixture views over the test tables of one scale-factor folder."""

    spark: SparkSession
    sf_dir: str

    def table(self, name: str) -> DataFrame:
        cache = self.__dict__.setdefault("_tables", {})
        if name not in cache:
            cache[name] = read_table(self.spark, self.sf_dir, name)
        return cache[name]

    @cached_property
    def base(self) -> DataFrame:
        return self.table("customer").selectExpr(*BASE_EXPRS)

    @property
    def nation(self) -> DataFrame:
        return self.table("nation")

    @property
    def roster(self) -> DataFrame:
        return self.base.selectExpr(*ROSTER_EXPRS)

    @property
    def contact(self) -> DataFrame:
        # nation is a small dimension; Spark broadcasts it from its size statistics.
        nation = self.nation.select("n_nationkey", "n_name")
        joined = self.base.filter(CONTACT_FILTER).join(nation, F.col("n_nationkey") == F.col("nk"), "left")
        return joined.selectExpr(*CONTACT_EXPRS)

    @property
    def hot_roster(self) -> DataFrame:
        return self.table("customer").selectExpr(*HOT_ROSTER_EXPRS)

    @property
    def hot_contact(self) -> DataFrame:
        return self.table("orders").selectExpr(*HOT_CONTACT_EXPRS)

    @property
    def dictionary(self) -> DataFrame:
        return self.spark.sql(DICTIONARY_SQL)

    @property
    def locality_dictionary(self) -> DataFrame:
        return self.spark.sql(LOCALITY_DICTIONARY_SQL)

    @property
    def education_dictionary(self) -> DataFrame:
        return self.spark.sql(EDUCATION_DICTIONARY_SQL)

    @property
    def origin_dictionary(self) -> DataFrame:
        region = self.table("region")
        return (self.nation.filter(ORIGIN_DICTIONARY_FILTER)
                .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
                .selectExpr(*ORIGIN_DICTIONARY_EXPRS))

    @property
    def id_master(self) -> DataFrame:
        return (self.base.filter(ID_MASTER_FILTER).selectExpr(*ID_MASTER_EXPRS)
                .unionByName(self.base.filter(ID_MASTER_TWICE_FILTER).selectExpr(*ID_MASTER_TWICE_EXPRS))
                .unionByName(self.spark.sql(ID_MASTER_NULL_ROW)))

    @property
    def baseline(self) -> DataFrame:
        return self.base.filter(BASELINE_FILTER).selectExpr(*BASELINE_EXPRS)

    @property
    def baseline_raw(self) -> DataFrame:
        return self.baseline.selectExpr(*BASELINE_RAW_EXPRS)
