"""Explicit schemas of the clinical source and era tables.

Concept and type ids are ``LongType`` in the canonical schemas, but the
operators only rely on column *names*: any id type that supports equality
works (the test fixtures use strings). Dates are always ``DateType``;
:func:`conform` casts timestamp columns once at load so every operator
stays in DATE arithmetic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_L = T.LongType()
_I = T.IntegerType()
_D = T.DateType()
_S = T.StringType()

# doses are packing keys, compared exactly: wide enough for any given scale
DOSE_TYPE = T.DecimalType(38, 18)


def _struct(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


DRUG_EXPOSURE = _struct(
    ("drug_exposure_id", _L, False),
    ("person_id", _L, False),
    ("drug_concept_id", _L, True),
    ("drug_type_concept_id", _L, True),
    ("drug_exposure_start_date", _D, True),
    ("drug_exposure_end_date", _D, True),
    ("days_supply", _I, True),
    ("dose_unit_concept_id", _L, True),
    ("effective_drug_dose", DOSE_TYPE, True),
)

CONDITION_OCCURRENCE = _struct(
    ("condition_occurrence_id", _L, False),
    ("person_id", _L, False),
    ("condition_concept_id", _L, True),
    ("condition_type_concept_id", _L, True),
    ("condition_start_date", _D, True),
    ("condition_end_date", _D, True),
)

CONCEPT_ANCESTOR = _struct(
    ("ancestor_concept_id", _L, False),
    ("descendant_concept_id", _L, False),
)

CONCEPT = _struct(
    ("concept_id", _L, False),
    ("vocabulary_id", _L, False),
    ("concept_class", _S, False),
)

CONDITION_ERA = _struct(
    ("person_id", _L, False),
    ("condition_concept_id", _L, False),
    ("condition_era_start_date", _D, False),
    ("condition_era_end_date", _D, False),
    ("condition_occurrence_count", _L, False),
)

DRUG_ERA = _struct(
    ("person_id", _L, False),
    ("drug_concept_id", _L, False),
    ("drug_era_start_date", _D, False),
    ("drug_era_end_date", _D, False),
    ("drug_exposure_count", _L, False),
    ("gap_days", _L, False),
)

DOSE_ERA = _struct(
    ("person_id", _L, False),
    ("drug_concept_id", _L, False),
    ("unit_concept_id", _L, False),
    ("dose_value", DOSE_TYPE, False),
    ("dose_era_start_date", _D, False),
    ("dose_era_end_date", _D, False),
)



def concept_schema(
    vocabulary_column: str = "vocabulary_id",
    class_column: str = "concept_class",
    vocabulary_type: T.DataType = _L,
) -> T.StructType:
    """``concept`` with the configured vocabulary / class column names (the
    scripts compare an integer ``vocabulary_id`` and ``concept_class``; other
    vocabularies name them ``vocabulary_id`` (text) and ``concept_class_id``)."""
    return _struct(
        ("concept_id", _L, False),
        (vocabulary_column, vocabulary_type, False),
        (class_column, _S, False),
    )


SOURCE_SCHEMAS = {
    "drug_exposure": DRUG_EXPOSURE,
    "condition_occurrence": CONDITION_OCCURRENCE,
    "concept_ancestor": CONCEPT_ANCESTOR,
    "concept": CONCEPT,
}

_DATE_LIKE = (T.DateType, T.TimestampType, T.TimestampNTZType)


class SchemaError(ValueError):
    pass


def require_columns(df: DataFrame, columns: list[str] | tuple[str, ...], what: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise SchemaError(f"{what}: missing columns {missing}; has {df.columns}")


def as_date(df: DataFrame, name: str) -> Column:
    """``name`` as a DATE column; timestamps are truncated to their date."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.DateType):
        return F.col(name)
    if isinstance(dtype, _DATE_LIKE):
        return F.to_date(F.col(name))
    raise SchemaError(f"column {name} must be a date or timestamp, found {dtype.simpleString()}")


def conform(df: DataFrame, schema: T.StructType, what: str) -> DataFrame:
    """Check that ``df`` has every column of ``schema``; cast dates to DATE.

    Id columns keep their own type (the operators are id-type agnostic);
    integer-like columns such as ``days_supply`` are cast to the schema type.
    Extra columns are kept.
    """
    require_columns(df, schema.fieldNames(), what)
    out = []
    for c in df.columns:
        if c not in schema.fieldNames():
            out.append(F.col(c))
            continue
        target = schema[c].dataType
        if isinstance(target, T.DateType):
            out.append(as_date(df, c).alias(c))
        elif c == "days_supply":
            out.append(F.col(c).cast(_I).alias(c))
        elif c == "effective_drug_dose" and not isinstance(df.schema[c].dataType, T.DecimalType):
            # doses are equality-compared packing keys: never keep them as double
            out.append(F.col(c).cast(DOSE_TYPE).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)
