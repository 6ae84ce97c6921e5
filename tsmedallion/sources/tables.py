"""Silver and gold at rest, CSV export and the table inventory."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tsmedallion.functions.scalar import export_name
from tsmedallion.schemas import GOLD, SILVER
from tsmedallion.session import materialise


LAYOUTS = ("folders", "clustered")


def _clustered(df: DataFrame, *columns: str) -> DataFrameWriter:
    """Even files, each a narrow range of ``columns``, without folders.

    Row-group bounds then prune a filter on the leading column. The row number
    lets the range exchange split even a group of rows equal on ``columns``.
    """
    return (
        df.withColumn("copy_no", F.monotonically_increasing_id())
        .repartitionByRange(*columns, "copy_no")
        .sortWithinPartitions(*columns)
        .drop("copy_no")
        .write
    )


def _check_layout(layout: str) -> None:
    if layout not in LAYOUTS:
        raise ValueError(f"layout must be one of {LAYOUTS}, not {layout!r}")


def write_silver(silver: DataFrame, path: str, layout: str = "folders") -> None:
    """Overwrite silver, by default with one folder per series.

    The rebalance puts a series' rows together, so that thousands of series do
    not become (tasks x series) files, and splits a hot series by size. With
    more series than a file system lists well, ``clustered`` needs no folders.
    """
    _check_layout(layout)
    if layout == "clustered":
        writer = _clustered(silver, "series_id", "observation_date")
    else:
        writer = silver.hint("rebalance", "series_id").write.partitionBy("series_id")
    writer.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def read_silver(spark: SparkSession, path: str) -> DataFrame:
    """Either layout. With the declared schema, keys that look like numbers
    stay text."""
    return spark.read.schema(SILVER).parquet(path).select(*SILVER.names)


def gold_path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{table}"


def write_gold(df: DataFrame, root: str, table: str, layout: str = "folders") -> None:
    """Rebuild a gold table; the fact gets one folder per indicator or is
    clustered by indicator and date.

    The fact arrives partitioned by its window keys (series, or chunk), so the
    folders add no shuffle. The time dimension is written in order of date.
    """
    _check_layout(layout)
    writer = df.orderBy("date_key").write if table == "dim_time" else df.write
    if table.startswith("fct_"):
        if layout == "clustered":
            writer = _clustered(df, "indicator_id", "date_key")
        else:
            writer = writer.partitionBy("indicator_id")
    writer.mode("overwrite").option("partitionOverwriteMode", "static").parquet(
        gold_path(root, table)
    )


def read_gold(
    spark: SparkSession, root: str, table: str, schema: T.StructType | None = None
) -> DataFrame:
    schema = schema or GOLD[table]
    return spark.read.schema(schema).parquet(gold_path(root, table)).select(*schema.names)


# Quotes are doubled and blanks kept, as other tools write and read them. CSV does not tell
# an empty text from a missing one: both are read back as NULL, as pandas reads them.
CSV = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def export_csv(df: DataFrame, folder: str, day: date, single_file: bool = False) -> str:
    """Write ``df`` with a header row per part, in parallel; returns the path.

    ``single_file`` makes one part in one task: only for a result of bounded size.
    """
    path = f"{folder.rstrip('/')}/{export_name(day)}"
    (df.coalesce(1) if single_file else df).write.mode("overwrite").options(**CSV).csv(path)
    return path


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """What ``export_csv`` wrote; values may hold line breaks."""
    return spark.read.schema(schema).options(**CSV, multiLine=True).csv(path)


def _folder(spark: SparkSession, path: str):
    """A Hadoop path and its file system."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def gold_layout(spark: SparkSession, root: str, table: str) -> str | None:
    """The layout that a gold fact was written with; None if it was not written."""
    folder, files = _folder(spark, gold_path(root, table))
    if not files.exists(folder):
        return None
    names = [s.getPath().getName() for s in files.listStatus(folder)]
    return "folders" if any("=" in n for n in names) else "clustered"


def replace_series(fact: DataFrame, touched: DataFrame, root: str, table: str) -> None:
    """Replace the rows of the touched series (series_id) in a gold fact by ``fact``.

    The table keeps its layout. With folders only those of touched series are written,
    and the folder of one that has no rows left is removed. A clustered table has no
    folders, so it is written anew with all other series as they were.
    """
    spark = fact.sparkSession
    if gold_layout(spark, root, table) == "clustered":
        kept = read_gold(spark, root, table, fact.schema).join(
            touched, F.col("indicator_id").eqNullSafe(F.col("series_id")), "left_anti"
        )
        write_gold(materialise(kept.unionByName(fact), "gold-fact"), root, table, "clustered")
        return
    fact = materialise(fact, "gold-series")
    fact.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "indicator_id"
    ).parquet(gold_path(root, table))
    emptied = touched.join(fact, F.col("series_id").eqNullSafe(F.col("indicator_id")), "left_anti")
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    for row in emptied.distinct().toLocalIterator():
        name = escape(row["series_id"]) if row["series_id"] else "__HIVE_DEFAULT_PARTITION__"
        folder, files = _folder(spark, f"{gold_path(root, table)}/indicator_id={name}")
        files.delete(folder, True)


def missing_tables(spark: SparkSession, expected: list[str]) -> list[str]:
    """Expected tables and views that the catalogue does not list."""
    return [name for name in expected if not spark.catalog.tableExists(name)]
