"""The driver's synthetic tables mapped onto the clinical source schemas.

``orders``   -> condition_occurrence
``lineitem`` ⋈ ``orders`` -> drug_exposure
``part``     -> concept_ancestor and concept (p_type = ingredient, p_brand =
               brand; every fifth size adds a second ingredient, which makes
               combination drugs)
``events``   -> generic (user, event type) one-day intervals

All reads use explicit schemas and select only the needed columns, so the
Parquet scan prunes columns and receives pushed filters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanpack.schemas import DRUG_EXPOSURE, conform

DOSE_TYPE = T.DecimalType(18, 2)
_TS = T.TimestampNTZType()

TESTDATA_SCHEMAS: dict[str, T.StructType] = {
    "orders": T.StructType([
        T.StructField("o_orderkey", T.LongType()),
        T.StructField("o_custkey", T.LongType()),
        T.StructField("o_orderstatus", T.StringType()),
        T.StructField("o_totalprice", T.DoubleType()),
        T.StructField("o_orderdate", _TS),
        T.StructField("o_orderpriority", T.StringType()),
    ]),
    "lineitem": T.StructType([
        T.StructField("l_orderkey", T.LongType()),
        T.StructField("l_partkey", T.LongType()),
        T.StructField("l_suppkey", T.LongType()),
        T.StructField("l_linenumber", T.IntegerType()),
        T.StructField("l_quantity", T.DoubleType()),
        T.StructField("l_extendedprice", T.DoubleType()),
        T.StructField("l_discount", T.DoubleType()),
        T.StructField("l_tax", T.DoubleType()),
        T.StructField("l_returnflag", T.StringType()),
        T.StructField("l_linestatus", T.StringType()),
        T.StructField("l_shipdate", _TS),
    ]),
    "part": T.StructType([
        T.StructField("p_partkey", T.LongType()),
        T.StructField("p_name", T.StringType()),
        T.StructField("p_brand", T.StringType()),
        T.StructField("p_type", T.StringType()),
        T.StructField("p_size", T.IntegerType()),
        T.StructField("p_retailprice", T.DoubleType()),
    ]),
    "events": T.StructType([
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", _TS),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]),
}

# Fixed values of the fixture mapping (shared with the SQL oracle).
INGREDIENT_CLASS = "Ingredient"
BRAND_CLASS = "Brand Name"
VOCABULARY = 8
SECOND_INGREDIENT_EVERY = 5      # p_size % 5 == 0 adds a second ingredient
PROMO, SMALL = "PROMO", "SMALL"
END_DAYS_MOD = 60                # condition end = start + orderkey % 60
NULL_END_MOD = 3                 # condition end NULL when orderkey % 3 == 0
SUPPLY_MOD = 40                  # days_supply = quantity % 40
DOSE_DIV = 25                    # dose = ceil(quantity / 25)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TESTDATA_SCHEMAS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def condition_occurrence(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders")
    start = F.to_date("o_orderdate")
    key = F.col("o_orderkey")
    end = F.when(key % NULL_END_MOD != 0, F.date_add(start, (key % END_DAYS_MOD).cast("int")))
    return o.select(
        key.alias("condition_occurrence_id"),
        F.col("o_custkey").alias("person_id"),
        F.col("o_orderpriority").alias("condition_concept_id"),
        F.col("o_orderstatus").alias("condition_type_concept_id"),
        start.alias("condition_start_date"),
        end.alias("condition_end_date"),
    )


def drug_exposure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _exposures_of_orders(spark, sf_dir).drop("_order")


def _exposures_of_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`drug_exposure` with the key of the order, never NULL, as ``_order``."""
    # the day goes through the join, not the time it is taken from
    l = read(spark, sf_dir, "lineitem").withColumn("l_shipdate", F.to_date("l_shipdate"))
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    x = l.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    start = F.col("l_shipdate")
    qty = F.col("l_quantity").cast("int")
    exposure_id = F.concat_ws(
        "|",
        *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")],
        F.date_format(start, "yyyy-MM-dd"),
    )
    return x.select(
        exposure_id.alias("drug_exposure_id"),
        F.col("o_custkey").alias("person_id"),
        F.col("l_partkey").alias("drug_concept_id"),
        F.col("l_returnflag").alias("drug_type_concept_id"),
        start.alias("drug_exposure_start_date"),
        F.when(F.col("l_linenumber") == 1, F.date_add(start, qty)).alias("drug_exposure_end_date"),
        F.when(F.col("l_returnflag") == "R", F.lit(None).cast("int"))
        .otherwise(qty % SUPPLY_MOD)
        .alias("days_supply"),
        F.col("l_linestatus").alias("dose_unit_concept_id"),
        F.when(F.col("l_discount") == 0, F.lit(None).cast(DOSE_TYPE))
        .otherwise(F.ceil(F.col("l_quantity") / DOSE_DIV).cast(DOSE_TYPE))
        .alias("effective_drug_dose"),
        F.col("l_orderkey").alias("_order"),
    )


def repeated_conditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`condition_occurrence` with ids that repeat: as they are, with a
    later end, or under another type."""
    co = condition_occurrence(spark, sf_dir)
    kind = F.col("condition_occurrence_id") % 4
    start, end = F.col("condition_start_date"), F.col("condition_end_date")
    later = co.filter(kind == 1).withColumn("condition_end_date", F.date_add(F.coalesce(end, start), 9))
    other = co.filter(kind == 2).withColumn("condition_type_concept_id", F.lit("Z"))
    return co.unionByName(co.filter(kind == 0)).unionByName(later).unionByName(other)


def repeated_exposures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`drug_exposure` with ids that repeat: as they are, with a longer
    supply and a later end, or under another type."""
    de = drug_exposure(spark, sf_dir)
    kind = F.split("drug_exposure_id", r"\|")[1].cast("int") % 3

    def variant(**changes) -> Column:
        names = ("drug_type_concept_id", "days_supply", "drug_exposure_end_date")
        return F.struct(*[changes.get(c, F.col(c)).alias(c) for c in names])

    # each record with its repetition, so that the join that makes records runs once
    later = variant(days_supply=F.col("days_supply") + 7, drug_exposure_end_date=F.date_add("drug_exposure_end_date", 7))
    other = variant(drug_type_concept_id=F.lit("Z"))
    copies = F.when(kind == 1, F.array(variant(), variant())).when(kind == 2, F.array(variant(), later)).when(kind == 0, F.array(variant(), other))
    rows = de.withColumn("_copies", F.coalesce(copies, F.array(variant())))
    kept = [c for c in de.columns if c not in ("drug_type_concept_id", "days_supply", "drug_exposure_end_date")]
    return rows.select(*kept, F.inline("_copies")).select(*de.columns)


def hot_exposures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`drug_exposure` with one drug concept for the exposures of every third order."""
    # the order's key itself: to cut it from the record id would read every column of the id
    concept = F.when(F.col("_order") % 3 == 0, F.lit(1)).otherwise(F.col("drug_concept_id"))
    return _exposures_of_orders(spark, sf_dir).withColumn("drug_concept_id", concept).drop("_order")


DIRTY_MOD = 13                   # which fault a record has follows from its concept or id


def dirty_conditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`condition_occurrence` with a fault in about every second row: NULL
    person, start, concept or type, the unmapped concept 0, an end before the start."""
    co = condition_occurrence(spark, sf_dir)
    fault = F.col("condition_occurrence_id") % DIRTY_MOD

    def unless(kind: int, column: str, value) -> dict:
        return {column: F.when(fault == kind, value).otherwise(F.col(column))}

    none = F.lit(None)
    return co.withColumns(
        unless(0, "person_id", none) | unless(1, "condition_start_date", none) | unless(4, "condition_type_concept_id", none)
        | {"condition_concept_id": F.when(fault == 2, none).when(fault == 3, F.lit("0")).otherwise(F.col("condition_concept_id")),
           "condition_end_date": F.when(fault == 5, F.date_sub("condition_start_date", 4)).otherwise(F.col("condition_end_date"))})


def dirty_exposures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`drug_exposure` with faults: NULL person, start, concept, type, unit,
    the unmapped drug 0, a drug without an ingredient, a negative supply, an end
    before the start."""
    de = drug_exposure(spark, sf_dir)
    fault = F.col("drug_concept_id") % DIRTY_MOD

    def unless(kind: int, column: str, value) -> dict:
        return {column: F.when(fault == kind, value).otherwise(F.col(column))}

    none = F.lit(None)
    concept_id = F.when(fault == 2, none).when(fault == 3, F.lit(0)).when(fault == 4, F.lit(-5)).otherwise(F.col("drug_concept_id"))
    return de.withColumns(
        unless(0, "person_id", none) | unless(1, "drug_exposure_start_date", none) | {"drug_concept_id": concept_id.cast("long")}
        | unless(5, "days_supply", -F.col("days_supply") - 3) | unless(6, "drug_type_concept_id", none)
        | unless(7, "drug_exposure_end_date", F.date_sub("drug_exposure_start_date", 4)) | unless(8, "dose_unit_concept_id", none))


def fine_doses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`drug_exposure` through :func:`spanpack.schemas.conform`, with
    double doses that differ in the fourth decimal."""
    part = F.split("drug_exposure_id", r"\|")
    dose = F.lit(0.0125) + (part[1].cast("int") % 3) * F.lit(0.0003)
    de = drug_exposure(spark, sf_dir).withColumn("effective_drug_dose", F.round(dose, 4))
    return conform(de, DRUG_EXPOSURE, "drug_exposure")


def concept_ancestor(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, "part")
    pk = F.col("p_partkey").alias("descendant_concept_id")
    second = F.when(F.col("p_type") == PROMO, F.lit(SMALL)).otherwise(F.lit(PROMO))
    return (
        p.select(pk, F.col("p_type").alias("ancestor_concept_id"))
        .unionByName(p.select(pk, F.col("p_brand").alias("ancestor_concept_id")))
        .unionByName(
            p.filter(F.col("p_size") % SECOND_INGREDIENT_EVERY == 0).select(
                pk, second.alias("ancestor_concept_id")
            )
        )
        .select("ancestor_concept_id", "descendant_concept_id")
    )


def concept(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, "part")

    def one(col: str, cls: str) -> DataFrame:
        return p.select(F.col(col).alias("concept_id")).distinct().select(
            "concept_id",
            F.lit(VOCABULARY).alias("vocabulary_id"),
            F.lit(cls).alias("concept_class"),
        )

    return one("p_type", INGREDIENT_CLASS).unionByName(one("p_brand", BRAND_CLASS))


def drug_sources(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return drug_exposure(spark, sf_dir), concept_ancestor(spark, sf_dir), concept(spark, sf_dir)


def event_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event as the one-day interval [date, date + 1] per (user, type)."""
    e = read(spark, sf_dir, "events")
    day = F.to_date("ts")
    return e.select(
        "event_id",
        "user_id",
        "event_type",
        day.alias("start_date"),
        F.date_add(day, 1).alias("end_date"),
    )
