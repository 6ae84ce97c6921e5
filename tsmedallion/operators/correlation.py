"""Pearson correlation of every pair of series, over the dates both have."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tsmedallion.schemas import local_table
from tsmedallion.session import materialise

# Series per matrix block: bounds the memory of a task to BLOCK**2 cells.
BLOCK = 512

# Dates per matrix product.
SLICE = 4096

# Below this share of its sum of squares, a variance is rounding.
ROUNDING = 1e-12

SUMS = ["n", "sx", "sy", "sxx", "syy", "sxy"]
MOMENTS = "i int, j int, " + ", ".join(f"{c} double" for c in SUMS)
NUMBERING = T.StructType(
    [T.StructField("number", T.IntegerType()), T.StructField("indicator_name", T.StringType())]
)


def corr_matrix(deduped: DataFrame, names: list[str]) -> DataFrame:
    """Long-form matrix: indicator_x, indicator_y, n_pairs, r.

    ``deduped`` has one row per (date, name). Values that are not finite are left out,
    pair by pair. Series are dealt into blocks; the points of a slice of dates and a pair
    of blocks make two date-by-series matrices in one task, whose products are the sums
    that every pair of their series needs. A point goes to one task per block, and the
    plan is the same for any number of series. Only pairs of blocks in order are
    computed; the rest is mirrored.

    One pair, or a series that does not vary over the shared dates, gives NULL.
    """
    if len(names) < 2:
        raise ValueError("a correlation needs at least two series")
    names = sorted(set(names))
    spark = deduped.sparkSession
    value = F.col("observation_value")
    finite = value.isNotNull() & ~F.isnan(value) & (F.abs(value) < F.lit(float("inf")))
    numbering = local_table(spark, list(enumerate(names)), NUMBERING)
    numbered = materialise(
        deduped.filter(finite & F.col("date_key").isNotNull())
        .join(numbering, "indicator_name")
        .select("date_key", "number", value.alias("value")),
        "points",
    )
    # Sums of squares cancel less around the mean.
    means = numbered.groupBy("number").agg(F.avg("value").alias("mean"))
    slices = numbered.agg(F.count_distinct("date_key")).first()[0] // SLICE + 1
    own = F.floor(F.col("number") / BLOCK).cast("int")
    others = F.sequence(F.lit(0), F.lit((len(names) - 1) // BLOCK))
    points = (
        numbered.join(means, "number")
        .select(
            F.pmod(F.hash("date_key"), F.lit(slices)).alias("slice"),
            "date_key",
            "number",
            (F.col("value") - F.col("mean")).alias("value"),
            F.explode(others).alias("other"),
        )
        .withColumns({"left": F.least(own, "other"), "right": F.greatest(own, "other")})
        .drop("other")
    )
    sums = (
        points.groupBy("left", "right", "slice")
        .applyInArrow(_moments(BLOCK), MOMENTS)
        .groupBy("i", "j")
        .agg(*[F.sum(c).alias(c) for c in SUMS])
    )
    n = F.col("n")
    spread_x = F.col("sxx") - F.col("sx") * F.col("sx") / n
    spread_y = F.col("syy") - F.col("sy") * F.col("sy") / n
    varies = (spread_x > ROUNDING * F.col("sxx")) & (spread_y > ROUNDING * F.col("syy"))
    product = F.col("sxy") - F.col("sx") * F.col("sy") / n
    r = F.when(varies, F.try_divide(product, F.sqrt(spread_x) * F.sqrt(spread_y)))
    upper = sums.select("i", "j", n.cast("long").alias("n_pairs"), r.alias("r"))

    # Every cell of the matrix, in both orientations, also without a pair.
    size = len(names)
    grid = spark.range(size * size).select(
        F.expr(f"CAST(id DIV {size} AS INT)").alias("x"),
        F.expr(f"CAST(id % {size} AS INT)").alias("y"),
    ).withColumns({"i": F.least("x", "y"), "j": F.greatest("x", "y")})
    x_names = numbering.toDF("x", "indicator_x")
    y_names = numbering.toDF("y", "indicator_y")
    return (
        grid.join(upper, ["i", "j"], "left")
        .join(x_names, "x")
        .join(y_names, "y")
        .select(
            "indicator_x", "indicator_y", F.coalesce("n_pairs", F.lit(0)).alias("n_pairs"), "r"
        )
    )


def _moments(block: int) -> Callable[[pa.Table], pa.Table]:
    """Sums for every pair of a series of the left and one of the right block."""

    def run(points: pa.Table) -> pa.Table:
        left, right = (points.column(c)[0].as_py() * block for c in ("left", "right"))
        number, value = points.column("number").to_numpy(), points.column("value").to_numpy()
        dates, row = np.unique(points.column("date_key").to_numpy(), return_inverse=True)

        def matrices(first: int) -> tuple[np.ndarray, np.ndarray]:
            here = (number >= first) & (number < first + block)
            cells = np.zeros((len(dates), number[here].max(initial=first) - first + 1))
            there = np.zeros_like(cells)
            at = row[here], number[here] - first
            cells[at], there[at] = value[here], 1.0
            return cells, there

        (x, in_x), (y, in_y) = matrices(left), matrices(right)
        sums = {
            "n": in_x.T @ in_y,
            "sx": x.T @ in_y,
            "sy": in_x.T @ y,
            "sxx": (x * x).T @ in_y,
            "syy": in_x.T @ (y * y),
            "sxy": x.T @ y,
        }
        i, j = np.nonzero(sums["n"])
        upper = i + left <= j + right
        i, j = i[upper], j[upper]
        cells = {"i": (i + left).astype(np.int32), "j": (j + right).astype(np.int32)}
        return pa.table(cells | {c: m[i, j] for c, m in sums.items()})

    return run
