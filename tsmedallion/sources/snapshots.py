"""Gold as versions: a reader pins one, a refresh adds one, nothing is changed in place.

    <root>/data/<table>-<id>/            rows, written once and never touched again
    <root>/versions/<number>.json        which folders make up each table of that version

A version comes into being when its file gets its name, by one rename that fails if the
number is taken. A run that dies before leaves folders that no version names, and the
version before it is the newest still.

A table is a list of layers, oldest first. Layers of the fact have cuts: of a series in
them, a layer holds all rows from a date on, and older layers those before. A layer of staging
holds whole years, and older layers the others. A version also names the raw rows of every
run date that it was made from, so that it is known what a repeated run replaces.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass, field

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tsmedallion.schemas import BRONZE_AT_REST, GOLD, STAGING

FACT = "fct_observations"
STAGED = "stg_observations"
SCHEMAS = GOLD | {STAGED: STAGING}
DATES = {FACT: "date_key", STAGED: "observation_date"}  # tables with a folder per year
CUTS = T.StructType([T.StructField("series_id", T.StringType()), T.StructField("from_date", T.DateType())])

# rows, and of the fact cuts, are folders; years, of staging, are numbers or None for rows without a date.
Layer = dict[str, str | list[int | None] | None]


class VersionTaken(RuntimeError):
    """Another run has published a version since this one began."""


def _hadoop_path(spark: SparkSession, name: str):
    return spark._jvm.org.apache.hadoop.fs.Path(name)


def versions(spark: SparkSession, root: str) -> list[int]:
    """The numbers of all versions, oldest first."""
    folder = _hadoop_path(spark, f"{root}/versions")
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return []
    names = [s.getPath().getName() for s in files.listStatus(folder)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))


@dataclass(frozen=True)
class Snapshot:
    """One version; reads of it see the same rows whatever is published later."""

    spark: SparkSession
    root: str
    number: int
    tables: dict[str, list[Layer]]
    runs: dict[str, str] = field(default_factory=dict)

    def read(self, table: str) -> DataFrame:
        return self.by_year(table).select(*SCHEMAS[table].names)

    def run(self, ingest_date: str) -> DataFrame:
        """The raw rows that this version has of a run date."""
        rows = self.spark.read.schema(BRONZE_AT_REST)
        folder = self.runs.get(ingest_date)
        return rows.parquet(folder) if folder else self.spark.createDataFrame([], BRONZE_AT_REST)

    def by_year(self, table: str) -> DataFrame:
        """The table with the ``year`` that its folders are made of, for filters to prune."""
        if table == STAGED:
            return self._staged()
        layers = self.tables[table]
        out = None
        for i, layer in enumerate(layers):
            rows = self._rows(table, layer)
            later = [x["cuts"] for x in layers[i + 1 :] if x["cuts"]]
            if later:
                cuts = self.spark.read.schema(CUTS).parquet(*later).groupBy("series_id").agg(F.min("from_date").alias("cut"))
                hidden = cuts.select(F.col("series_id").alias("cut_series"), "cut", F.lit(True).alias("is_cut"))
                rows = (
                    rows.join(hidden, F.col("indicator_id").eqNullSafe(F.col("cut_series")), "left")
                    .where(F.col("is_cut").isNull() | (F.col("date_key") < F.col("cut")))
                    .drop("cut_series", "cut", "is_cut")
                )
            out = rows if out is None else out.unionByName(rows)
        return out

    def _staged(self) -> DataFrame:
        """Every year from the newest layer that has it; a layer with none left is not read."""
        out, seen = None, set()
        for layer in reversed(self.tables[STAGED]):
            years = set(layer["years"]) - seen
            seen |= years
            if years:
                rows = self._rows(STAGED, layer).filter(in_years(years))
                out = rows if out is None else rows.unionByName(out)
        return self.spark.createDataFrame([], _by_year(STAGED)) if out is None else out

    def _rows(self, table: str, layer: Layer) -> DataFrame:
        schema = _by_year(table) if table in DATES else SCHEMAS[table]
        return self.spark.read.schema(schema).parquet(layer["rows"])

    def years(self) -> list[int]:
        """The years that the fact has folders for."""
        found = set()
        for layer in self.tables[FACT]:
            folder = _hadoop_path(self.spark, layer["rows"])
            files = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
            names = [s.getPath().getName().partition("=") for s in files.listStatus(folder)]
            found |= {int(value) for key, _, value in names if key == "year" and value.isdigit()}
        return sorted(found)


def _by_year(table: str) -> T.StructType:
    return T.StructType([*SCHEMAS[table].fields, T.StructField("year", T.IntegerType())])


def in_years(years: set[int | None]) -> Column:
    """Filters the folders of these years; None is that of rows without a date."""
    dated = F.col("year").isin([y for y in years if y is not None])
    return dated | F.col("year").isNull() if None in years else dated


def open_snapshot(spark: SparkSession, root: str, number: int | None = None) -> Snapshot:
    """A version by its number, or the newest."""
    number = max(versions(spark, root)) if number is None else number
    (row,) = spark.read.text(f"{root}/versions/{number:020d}.json", wholetext=True).collect()
    held = json.loads(row[0])
    return Snapshot(spark, root, number, held["tables"], held["runs"])


def write_layer(
    df: DataFrame, root: str, table: str, cuts: DataFrame | None = None, years: set[int | None] | None = None
) -> Layer:
    """Rows of a table in a folder that no version names yet, with the cuts or years that they stand for."""
    path = f"{root}/data/{table}-{uuid.uuid4().hex}"
    if table in DATES:
        rows = df.withColumn("year", F.year(DATES[table])).hint("rebalance", "year")
        rows.write.partitionBy("year").parquet(path)
    else:
        df.write.parquet(path)
    if cuts is not None:
        cuts.select(*CUTS.names).write.parquet(f"{path}-cuts")
    held = {"rows": path, "cuts": f"{path}-cuts" if cuts is not None else None}
    return held if years is None else held | {"years": sorted(years, key=lambda y: (y is None, y))}


def write_run(bronze: DataFrame, root: str) -> str:
    """The raw rows of a run date, in a folder that no version names yet."""
    path = f"{root}/data/bronze-{uuid.uuid4().hex}"
    bronze.select(*BRONZE_AT_REST.names).write.parquet(path)
    return path


def publish(
    spark: SparkSession, root: str, after: int, tables: dict[str, list[Layer]], runs: dict[str, str] | None = None
) -> int:
    """Name the version behind ``after``; raises ``VersionTaken`` if there is one by now."""
    number = after + 1
    conf, text = spark._jsc.hadoopConfiguration(), json.dumps({"tables": tables, "runs": runs or {}}).encode()
    draft = _hadoop_path(spark, f"{root}/drafts/{uuid.uuid4().hex}")
    target = _hadoop_path(spark, f"{root}/versions/{number:020d}.json")
    files = draft.getFileSystem(conf)
    out = files.create(draft, False)
    try:
        out.write(bytearray(text))
    finally:
        out.close()
    files.mkdirs(target.getParent())
    fs = spark._jvm.org.apache.hadoop.fs
    qualified = [files.makeQualified(p) for p in (draft, target)]
    # Without the option to overwrite, a rename onto a file that exists fails.
    no_options = spark.sparkContext._gateway.new_array(fs.Options.Rename, 0)
    try:
        fs.FileContext.getFileContext(qualified[0].toUri(), conf).rename(*qualified, no_options)
    except Exception as error:
        if isinstance(error, PySparkException) or "FileAlreadyExistsException" not in str(error):
            raise
        raise VersionTaken(f"version {number} of {root} is there already") from error
    return number


def _named(tables: dict[str, list[Layer]], runs: dict[str, str]) -> set[str]:
    """The last parts of all folders that a version names."""
    folders = [x[k] for layers in tables.values() for x in layers for k in ("rows", "cuts") if x.get(k)]
    return {f.rstrip("/").rpartition("/")[2] for f in (*folders, *runs.values())}


def expire(spark: SparkSession, root: str, keep: int, unused_for_hours: float = 24.0) -> list[str]:
    """Delete all but the newest ``keep`` versions and the folders that none of these names.

    Folders younger than ``unused_for_hours`` stay: a run that has not published yet may have written
    them. Returns the names of what was deleted. Versions go first, so that none ever names a folder that is gone.
    """
    if keep < 1:
        raise ValueError("at least one version must be kept")
    numbers = versions(spark, root)
    held = [open_snapshot(spark, root, n) for n in numbers[-keep:]]
    used = set().union(*(_named(s.tables, s.runs) for s in held))
    gone = []
    conf = spark._jsc.hadoopConfiguration()
    for n in numbers[:-keep]:
        path = _hadoop_path(spark, f"{root}/versions/{n:020d}.json")
        path.getFileSystem(conf).delete(path, False)
        gone.append(path.getName())
    folder = _hadoop_path(spark, f"{root}/data")
    files = folder.getFileSystem(conf)
    before = time.time() * 1000 - unused_for_hours * 3_600_000
    for status in files.listStatus(folder) if held and files.exists(folder) else []:
        name = status.getPath().getName()
        if name not in used and status.getModificationTime() <= before:
            files.delete(status.getPath(), True)
            gone.append(name)
    return gone
