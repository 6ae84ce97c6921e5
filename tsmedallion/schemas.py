"""Declared schemas of every layer, the series catalogue and the drift check."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def _schema(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields.items()])


_STR, _DBL, _INT = T.StringType(), T.DoubleType(), T.IntegerType()
_DATE, _TS, _NTZ, _BOOL = T.DateType(), T.TimestampType(), T.TimestampNTZType(), T.BooleanType()

OBSERVATION = _schema(realtime_start=_STR, realtime_end=_STR, date=_STR, value=_STR)

DOCUMENT = _schema(observations=T.ArrayType(OBSERVATION))

# A document that could not be read; the partition column comes last at rest.
QUARANTINE = _schema(ingest_date=_STR, series_id=_STR, file=_STR, cause=_STR, rescued=_STR)

BRONZE = _schema(
    realtime_start=_STR,
    realtime_end=_STR,
    date=_STR,
    value=_STR,
    series_id=_STR,
    series_name=_STR,
    ingestion_timestamp=_STR,
)

# Bronze at rest: the two partition columns come last, as Spark reads them back.
BRONZE_AT_REST = _schema(
    realtime_start=_STR,
    realtime_end=_STR,
    date=_STR,
    value=_STR,
    series_name=_STR,
    ingestion_timestamp=_STR,
    ingest_date=_STR,
    series_id=_STR,
)

SILVER = _schema(
    series_id=_STR,
    series_name=_STR,
    observation_date=_DATE,
    value=_DBL,
    value_raw=_STR,
    is_missing=_BOOL,
    is_valid=_BOOL,
    realtime_start=_STR,
    realtime_end=_STR,
    ingestion_timestamp=_STR,
    date_raw=_STR,
)

STAGING = _schema(
    series_id=_STR,
    series_name=_STR,
    observation_date=_DATE,
    value=_DBL,
    data_as_of_date=_STR,
    ingested_at=_NTZ,
    transformed_at=_TS,
)

DIM_INDICATORS = _schema(
    indicator_id=_STR, indicator_name=_STR, category=_STR, frequency=_STR, created_at=_TS
)

DIM_TIME = _schema(
    date_key=_DATE,
    observation_date=_DATE,
    year=_INT,
    quarter=_INT,
    month=_INT,
    day=_INT,
    day_of_week=_INT,
    day_of_year=_INT,
    month_start=_DATE,
    quarter_start=_DATE,
    year_start=_DATE,
    is_weekend=_BOOL,
)

FCT_OBSERVATIONS = _schema(
    indicator_id=_STR,
    date_key=_DATE,
    observation_value=_DBL,
    previous_value=_DBL,
    value_year_ago=_DBL,
    period_change_pct=_DBL,
    yoy_change_pct=_DBL,
    data_as_of_date=_STR,
    ingested_at=_NTZ,
    created_at=_TS,
)

GOLD = {
    "dim_indicators": DIM_INDICATORS,
    "dim_time": DIM_TIME,
    "fct_observations": FCT_OBSERVATIONS,
}

CATALOGUE = _schema(series_id=_STR, series_name=_STR, category=_STR, frequency=_STR)

# The tracked series with display name, category and frequency.
DEFAULT_CATALOGUE = [
    ("GDP", "Gross Domestic Product", "Output", "Quarterly/Monthly"),
    ("UNRATE", "Unemployment Rate", "Labor Market", "Monthly"),
    ("CPIAUCSL", "Consumer Price Index", "Inflation", "Quarterly/Monthly"),
    ("DFF", "Federal Funds Rate", "Monetary Policy", "Daily"),
    ("UMCSENT", "Consumer Sentiment Index", "Sentiment", "Monthly"),
]

# Fixed value: the first observation date that is ingested.
DEFAULT_OBSERVATION_START = "2020-01-01"


def local_table(
    spark: SparkSession, rows: list[tuple], schema: T.StructType
) -> DataFrame:
    """A small literal table. Passed as Arrow it becomes a local relation of
    known size, so that joins can broadcast it."""
    columns = {name: [row[i] for row in rows] for i, name in enumerate(schema.names)}
    return spark.createDataFrame(pa.table(columns, schema=to_arrow_schema(schema)))


def default_catalogue(spark: SparkSession) -> DataFrame:
    return local_table(spark, DEFAULT_CATALOGUE, CATALOGUE)


def schema_drift(df: DataFrame, expected: T.StructType) -> list[str]:
    """Differences between the columns of ``df`` and the declared schema."""
    found = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    wanted = {f.name: f.dataType.simpleString() for f in expected.fields}
    problems = [f"missing column {name} {wanted[name]}" for name in wanted if name not in found]
    problems += [f"unexpected column {name} {found[name]}" for name in found if name not in wanted]
    problems += [
        f"column {name} is {found[name]}, expected {wanted[name]}"
        for name in wanted
        if name in found and found[name] != wanted[name]
    ]
    return problems


def check_schema(df: DataFrame, expected: T.StructType) -> DataFrame:
    problems = schema_drift(df, expected)
    if problems:
        raise ValueError("schema drift: " + "; ".join(problems))
    return df


def check_at_rest(
    spark: SparkSession, path: str, expected: T.StructType, partition_cols: tuple[str, ...] = ()
) -> None:
    """Compare files with the declared schema; reads one footer, no rows.

    A declared schema alone would read a missing column as NULL.
    """
    declared = T.StructType([f for f in expected.fields if f.name not in partition_cols])
    check_schema(spark.read.parquet(path).drop(*partition_cols), declared)
