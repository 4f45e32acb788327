"""Bindings: the driver's test tables shaped as the nine clinical inputs.

The test data is a TPC-H-like star schema.  Each binding below is a
deterministic DataFrame expression over whole tables, so its size grows with
the scale factor; ``FIXTURES.md`` states every rule in words and the DuckDB
oracle restates them in SQL.

customer -> cohort, persons      nation -> location      region -> manifest
lineitem + orders -> visits, conditions      part -> members
orders -> death                  sets: the eight chosen concept sets
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.sources.io import conform
from cohortlens.sources.tables import Tables

# The columns of the test tables that the bindings read, with
# their stored types (the same at every scale factor).  Declaring them skips
# schema inference from the Parquet footers on every read.
TEST_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_nationkey int",
    "part": "p_partkey bigint, p_type string, p_size int",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp_ntz, "
    "o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_shipdate timestamp_ntz",
}
TABLES = tuple(TEST_SCHEMAS)

# Race names assigned by c_custkey % 38, in this order.  The
# last two rows check case sensitivity and a missing race.
RACE_NAMES = [
    "Hispanic White", "Black", "African American", "African", "White",
    "Asian or Pacific Islander", "Asian", "Filipino", "Chinese", "Korean",
    "Vietnamese", "Japanese", "Bangladeshi", "Pakistani", "Nepalese", "Laotian",
    "Taiwanese", "Thai", "Sri Lankan", "Burmese", "Okinawan", "Cambodian",
    "Bhutanese", "Singaporean", "Hmong", "Malaysian", "Indonesian",
    "Native Hawaiian or Other Pacific Islander", "Polynesian", "Native Hawaiian",
    "Micronesian", "Melanesian", "Other Race", "Multiple races",
    "More than one population", "Barbadian", "white", None,
]

# The chosen concept sets
# (concept_set_name, column_name, domain, comorbidity, er_only_visit).
CONCEPT_SETS = [
    ("SMALL", "small_flag", "condition_occurrence", 1, 0),
    ("LARGE", "large_flag", "condition_occurrence,drug_exposure", 1, 0),
    ("PROMO", "promo_flag", "condition_occurrence", 1, 0),
    ("MEDIUM", "medium_flag", "condition_occurrence", 0, 0),
    ("ECONOMY", "economy_flag", "drug_exposure", 1, 0),
    ("STANDARD", "standard_flag", "condition_occurrence", None, 0),
    ("NOEVENT", "noevent_flag", "condition_occurrence", 1, 0),
    ("ER", "er_visit", "visit_occurrence", 0, 1),
]

# Visit concept ids (inpatient, outpatient), and the first of the
# ten emergency room concepts.
INPATIENT, OUTPATIENT, EMERGENCY = 9201, 9202, 9300


def read_test_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: spark.read.schema(ddl).parquet(f"{sf_dir}/{name}.parquet") for name, ddl in TEST_SCHEMAS.items()}


def _date(c: str) -> Column:
    return F.col(c).cast(T.DateType())


def _null_if(cond: Column, value: Column) -> Column:
    return F.when(~cond, value)


def cohort(customer: DataFrame, orders: DataFrame) -> DataFrame:
    """Index dates per customer: earliest urgent order (lab), earliest high one (diagnosis)."""
    dated = orders.select("o_custkey", "o_orderpriority", _date("o_orderdate").alias("d"))
    firsts = dated.groupBy("o_custkey").agg(
        F.min(F.when(F.col("o_orderpriority") == "1-URGENT", F.col("d"))).alias("pcr"),
        F.min(F.when(F.col("o_orderpriority") == "2-HIGH", F.col("d"))).alias("dx"),
    )
    index = F.least("pcr", "dx")
    return (
        customer.select(F.col("c_custkey").alias("person_id"))
        .join(firsts, F.col("person_id") == F.col("o_custkey"), "left")
        .select(
            "person_id",
            F.col("pcr").alias("first_pos_pcr_antigen_date"),
            F.col("dx").alias("first_pos_diagnosis_date"),
            index.alias("first_poslab_or_diagnosis_date"),
            index.alias("first_antigen_or_poslab_or_diagnosis_date"),
        )
    )


def index_rows(orders: DataFrame) -> DataFrame:
    """Every urgent or high-priority order of a person as an index date: many rows a person."""
    chosen = orders.where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))
    return chosen.select(F.col("o_custkey").alias("person_id"), _date("o_orderdate").alias("index_date")).distinct()


def persons(customer: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    race = F.element_at(F.array(*[F.lit(r).cast("string") for r in RACE_NAMES]), (k % 38 + 1).cast("int"))
    gender = (
        F.when(k % 5 == 0, "Male").when(k % 5 == 1, "FEMALE").when(k % 5 == 2, "female")
        .when(k % 5 == 3, "No matching concept")
    )
    ethnicity = F.when(k % 7 == 0, "Hispanic or Latino").when(k % 7 != 1, "Not Hispanic or Latino")
    return customer.select(
        k.alias("person_id"),
        _null_if(k % 41 == 0, 1930 + k % 75).cast("int").alias("year_of_birth"),
        _null_if(k % 13 == 0, k % 12 + 1).cast("int").alias("month_of_birth"),
        _null_if(k % 11 == 0, k % 31 + 1).cast("int").alias("day_of_birth"),
        ethnicity.alias("ethnicity_concept_name"),
        race.alias("race_concept_name"),
        gender.alias("gender_concept_name"),
        _null_if(k % 29 == 0, F.col("c_nationkey")).alias("location_id"),
        (F.col("c_nationkey") % 6).alias("data_partner_id"),
    )


def location(nation: DataFrame) -> DataFrame:
    n = F.col("n_nationkey")
    zip_ = (
        F.when(n % 6 == 0, F.concat(F.lit("1000"), (n % 10).cast("string")))
        .when(n % 6 == 1, " 20001 ")
        .when(n % 6 == 2, "30001-1234")
        .when(n % 6 == 3, "4001")
        .when(n % 6 == 4, "50A01")
    )
    return nation.select(
        n.alias("location_id"),
        F.col("n_name").alias("city"),
        F.concat(F.lit("S"), F.col("n_regionkey").cast("string")).alias("state"),
        zip_.alias("zip"),
        F.concat(F.lit("C"), n.cast("string")).alias("county"),
    )


def manifest(region: DataFrame) -> DataFrame:
    r = F.col("r_regionkey")
    return region.select(
        r.alias("data_partner_id"),
        F.lit("2022-06-10").cast("date").alias("run_date"),
        F.col("r_name").alias("cdm_name"),
        F.lit("5.3").alias("cdm_version"),
        F.when(r % 2 == 0, "Y").otherwise("N").alias("shift_date_yn"),
        (r * 10).cast("int").alias("max_num_shift_days"),
    )


def _lines(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    return lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))


def visits(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """One visit per line item; the order is a hospital stay unless its status is O."""
    line = F.col("l_linenumber")
    open_order = F.col("o_orderstatus") == "O"
    concept = (
        F.when(open_order, F.when(line == 1, OUTPATIENT).otherwise(EMERGENCY + F.col("l_partkey") % 10))
        .when(line % 3 == 0, INPATIENT)
        .otherwise(OUTPATIENT)
    )
    ship = _date("l_shipdate")
    order_date = _date("o_orderdate")
    return _lines(lineitem, orders).select(
        F.col("o_custkey").alias("person_id"),
        (F.col("l_orderkey") * 10 + line).alias("visit_occurrence_id"),
        concept.cast("int").alias("visit_concept_id"),
        F.concat(F.lit("visit "), concept.cast("string")).alias("visit_concept_name"),
        ship.alias("visit_start_date"),
        F.date_add(ship, (line % 4).cast("int")).alias("visit_end_date"),
        F.when(~open_order, F.col("o_orderkey").cast("string")).alias("macrovisit_id"),
        F.when(~open_order, order_date).alias("macrovisit_start_date"),
        F.when(F.col("o_orderstatus") == "F", F.date_add(order_date, (F.col("o_orderkey") % 10).cast("int")))
        .alias("macrovisit_end_date"),
    )


def members(part: DataFrame) -> DataFrame:
    """Each part is a concept of its type; each medium part also lists an ER concept, by its size."""
    current = (F.col("p_size") % 2 == 0).alias("is_most_recent_version")
    concepts = part.select(F.col("p_partkey").alias("concept_id"), F.col("p_type").alias("concept_set_name"), current)
    er = part.where(F.col("p_type") == "MEDIUM").select(
        (EMERGENCY + F.col("p_size") % 10).cast("long").alias("concept_id"), F.lit("ER").alias("concept_set_name"), current
    )
    return concepts.unionByName(er)


def sets(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        CONCEPT_SETS,
        "concept_set_name string, column_name string, domain string, comorbidity int, er_only_visit int",
    )


def conditions(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """One coded condition per line item: the part is the concept; line 7 has no date."""
    return _lines(lineitem, orders).select(
        F.col("o_custkey").alias("person_id"),
        _null_if(F.col("l_linenumber") == 7, _date("l_shipdate")).alias("condition_start_date"),
        F.col("l_partkey").alias("condition_concept_id"),
    )


def death(orders: DataFrame) -> DataFrame:
    """Finished low-priority orders are death records; a person may have several."""
    return orders.where((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "5-LOW")).select(
        F.col("o_custkey").alias("person_id"),
        (F.col("o_orderkey") % 6).alias("data_partner_id"),
        _date("o_orderdate").alias("death_date"),
    )


def bind(spark: SparkSession, raw: dict[str, DataFrame]) -> Tables:
    t = Tables(
        cohort=cohort(raw["customer"], raw["orders"]),
        persons=persons(raw["customer"]),
        location=location(raw["nation"]),
        manifest=manifest(raw["region"]),
        visits=visits(raw["lineitem"], raw["orders"]),
        members=members(raw["part"]),
        sets=sets(spark),
        conditions=conditions(raw["lineitem"], raw["orders"]),
        death=death(raw["orders"]),
    )
    return Tables(**{name: conform(getattr(t, name), name) for name in t.names()})  # as ``read_table`` does


def bound_tables(spark: SparkSession, sf_dir: str) -> Tables:
    """The nine clinical inputs bound over the test tables in ``sf_dir``."""
    return bind(spark, read_test_tables(spark, sf_dir))
