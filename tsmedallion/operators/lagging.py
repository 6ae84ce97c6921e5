"""LAG over rows of a partition that may hold any share of the data.

``F.lag`` over ``Window.partitionBy(series)`` sorts a whole series in one task.
Where a series is bounded (one row per day) that is the best plan. Where it is
not, ``chunked_lag`` sorts all rows over the cluster into even chunks, hands
every chunk the few rows that precede it, and runs the window per chunk.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tsmedallion.session import materialise

# monotonically_increasing_id() keeps the row's place in its task in 33 bits.
ROW_IN_TASK = (1 << 33) - 1

# Bytes of input and rows that one chunk, and so one task, should sort. Rows count too, as
# bytes at rest or in a shuffle are compressed, and the sort holds rows as they are.
CHUNK_BYTES = 128 << 20
CHUNK_ROWS = 1 << 19
UNKNOWN_BYTES = (1 << 63) - 1
MAX_CHUNKS = 1 << 20


def _chunks(df: DataFrame) -> list[int]:
    """The number of chunks that the size of the tables read asks for, if that is over
    the session's shuffle partitions, which AQE could only lower. A relation that is no
    table has no known size, which Spark gives as the largest number; it does not count."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    wanted = -(-sum(s for s in sizes if s < UNKNOWN_BYTES) // CHUNK_BYTES)
    usual = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return [min(wanted, MAX_CHUNKS)] if wanted > usual else []


def chunk_number(df: DataFrame, rows: int | None = None) -> list[int]:
    """The number of chunks that bytes and rows ask for; none where one chunk could hold all,
    and AQE may do as it likes. ``rows`` is a bound on those of ``df``, else they are counted."""
    rows = df.count() if rows is None else rows
    wanted = max([-(-rows // CHUNK_ROWS), *_chunks(df)])
    return [min(wanted, MAX_CHUNKS)] if wanted > 1 else []


def sorted_chunks(df: DataFrame, sorting: list[Column], number: list[int] | None = None) -> DataFrame:
    """``df`` in order over even chunks, with each row's ``chunk`` and its ``pos`` there.

    A range exchange makes the chunks even whatever the skew, as many as the size of the input
    asks for. Rows equal on all of ``sorting`` are told apart by a row number, so even
    one group of copies spreads over several. The chunks are written once: their bounds
    come from a sample, so they must not be computed twice.
    """
    return materialise(
        df.withColumn("copy_no", F.monotonically_increasing_id())
        .repartitionByRange(*(chunk_number(df) if number is None else number), *sorting, "copy_no")
        .sortWithinPartitions(*sorting)
        .withColumn("chunk", F.spark_partition_id())
        .withColumn("pos", F.monotonically_increasing_id().bitwiseAND(F.lit(ROW_IN_TASK)))
        .drop("copy_no"),
        "chunked",
    )


def by_chunk(chunked: DataFrame, number: list[int]) -> DataFrame:
    """One chunk to a task, for a window over each. A hash of their numbers would deal several to
    one task, and AQE would join tasks by compressed bytes, so that one sorts many chunks at once."""
    return chunked.repartitionById(*number, F.col("chunk")) if number else chunked


def chunked_lag(
    df: DataFrame,
    key: str,
    order: list[str],
    value: str,
    offsets: dict[str, int],
    nulls_last: list[str],
) -> DataFrame:
    """``LAG(value, n) OVER (PARTITION BY key ORDER BY order)`` per ``{name: n}``.

    The rows are sorted into even chunks by (key, order). A row looks back ``max(n)``
    rows at most, so a chunk needs that many rows from before its start, and nothing
    else, from other chunks.

    ``df`` should come straight from a table scan, whose rows a retried task
    reads in the same order; write the result of a join first.
    """
    depth = max(offsets.values())
    sorting = [F.col(key).asc_nulls_first()] + [
        F.col(c).asc_nulls_last() if c in nulls_last else F.col(c).asc_nulls_first()
        for c in order
    ]
    number = chunk_number(df)
    chunked = sorted_chunks(df, sorting, number)

    # One row per chunk: small enough for one window task and for a broadcast.
    before = Window.orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = F.broadcast(
        chunked.groupBy("chunk")
        .agg(F.count("*").alias("n_rows"))
        .withColumn("start", F.coalesce(F.sum("n_rows").over(before), F.lit(0)))
    )
    tails = (
        chunked.select("chunk", "pos", key, value)
        .join(starts, "chunk")
        .filter(F.col("pos") >= F.col("n_rows") - depth)
        .select(key, value, (F.col("start") + F.col("pos")).alias("row_no"))
    )
    # A tail row goes to every chunk that starts within ``depth`` rows after it:
    # the next one, and further ones where chunks are shorter than that.
    reach = F.sequence(F.col("row_no") + 1, F.col("row_no") + depth)
    carried = (
        tails.withColumn("start", F.explode(reach))
        .join(starts.select("chunk", "start"), "start")
        .select(key, value, "chunk", (F.col("row_no") - F.col("start")).alias("pos"))
    )

    # Chunks are contiguous in (key, order), so the place in the chunk is the
    # order, and a row of another key marks the start of the partition.
    in_chunk = Window.partitionBy("chunk").orderBy("pos")

    def lagged(n: int) -> Column:
        same_key = F.lag(key, n).over(in_chunk).eqNullSafe(F.col(key))
        return F.when(same_key, F.lag(value, n).over(in_chunk))

    return (
        by_chunk(chunked.unionByName(carried, allowMissingColumns=True), number)
        .withColumns({name: lagged(n) for name, n in offsets.items()})
        .filter(F.col("pos") >= 0)
        .drop("chunk", "pos")
    )
