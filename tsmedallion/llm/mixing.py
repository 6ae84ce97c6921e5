"""Mixing sources to target weights by entropy balancing.

Every document has a rate, the number of copies expected of it. Rates are as close as they
can be (in relative entropy) to one copy each, under the constraint that the words of each
source come to its target and no rate exceeds ``MOST``. The solution is an exponential tilt,
``min(MOST, exp(lambda * size / mean size))`` with one multiplier per source; the convex dual
is solved for all sources at once by Newton steps, kept inside a bracket. A step is one
aggregation over (source, size, number of documents), which is all that the rates depend on.

Rates become copies in three exact steps: running totals of the rates, by size within each
source, are rounded to whole copies of each size; single copies are then added or taken where
that brings a source closer to its target; and the copies of one size are dealt evenly to its
documents, first to salts, then to the documents of a salt. A source or a size with a third
of all documents is thus never one task's work: a running total is over sizes (at most as
many as the longest text has words) or salts, and documents are ranked within a salt.

* A null text has size 0; documents of size 0 keep one copy and take no words.
* Rows without a source are a source of their own, last in order. A source of size 0 has
  target 0. Repeated rows are mixed as rows of their own.
* Reruns agree: ties are broken by hashes of id and text, never by place or task.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tsmedallion.llm.common import unused
from tsmedallion.session import materialise

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST = 2
SALTS = 256
TOLERANCE = 1e-7
STEPS = 60
REPAIRS = 4


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_key(source: Column) -> Column:
    """Orders sources by code point, null last."""
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source.cast("string")))


def targets(sources: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """``sources`` (key, total: one row each) with weight and target.

    Sources share ``share`` of all words by weight, up to ``most`` times their own; what is
    cut off is shared anew by weight. That ends at ``min(most * total, level * weight)`` with
    the one level that uses up the words: sources are taken in order of the level at which
    they are full. The windows here run over one row per source.
    """
    by_key = Window.orderBy("key")
    full = Window.orderBy(F.col("cap") / F.col("weight"), "key")
    before = full.rowsBetween(Window.unboundedPreceding, -1)
    onward = full.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    place = (F.row_number().over(by_key) - 1) % len(weights) + 1
    budget = F.lit(share) * F.sum("total").over(Window.partitionBy()).cast("double")
    level = (budget - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(onward)
    return (
        sources.withColumn("weight", F.element_at(F.array(*map(F.lit, map(float, weights))), place.cast("int")))
        .withColumn("cap", F.lit(most) * F.col("total").cast("double"))
        .withColumn("level", level)
        .withColumn("fits", F.col("level") * F.col("weight") <= F.col("cap"))
        .withColumn("level", F.max(F.when(F.col("fits"), F.col("level"))).over(Window.partitionBy()))
        .withColumn("target", F.coalesce(F.least(F.col("cap"), F.col("level") * F.col("weight")), F.col("cap")))
        .select("key", "total", "weight", "target")
    )


def _rate(most: int) -> Column:
    """Expected copies at multiplier ``tilt`` and relative size ``z``; full: every rate is ``most``."""
    tilted = F.exp(F.least(F.col("tilt") * F.col("z"), F.lit(math.log(most))))
    return F.when(F.col("full"), F.lit(float(most))).when(F.col("none"), F.lit(0.0)).otherwise(tilted)


def balance(sizes: DataFrame, sources: DataFrame, most: int = MOST) -> DataFrame:
    """``sources`` with the multiplier ``tilt`` that solves the dual; sizes: key, size, n."""
    words = sizes.where("size > 0")
    about = words.groupBy("key").agg((F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("mean"))
    state = sources.join(about, "key", "left").select(
        "key",
        "total",
        "target",
        "mean",
        (F.col("target") >= F.lit(most) * F.col("total")).alias("full"),
        ((F.col("target") <= 0) & (F.col("total") > 0)).alias("none"),
        F.lit(0.0).alias("tilt"),
        F.lit(None).cast("double").alias("low"),
        F.lit(None).cast("double").alias("high"),
        F.lit(math.inf).alias("gap"),
    )
    state = materialise(state, "tilts")
    for _ in range(STEPS):
        z = F.col("size") / F.col("mean")
        rates = words.join(state.where("not full and not none"), "key").withColumn("z", z).withColumn("rate", _rate(most))
        moment = F.col("n") * F.col("size") * F.col("rate")
        free = F.col("rate") < F.lit(float(most))
        sums = rates.groupBy("key").agg(
            F.sum(moment).alias("value"), F.sum(F.when(free, moment * F.col("z")).otherwise(0.0)).alias("slope")
        )
        over = F.col("value") > F.col("target")
        step = (
            state.join(sums, "key", "left")
            .withColumn("gap", F.coalesce(F.abs(F.col("value") / F.col("target") - 1), F.lit(0.0)))
            .withColumn("high", F.when(over, F.col("tilt")).otherwise(F.col("high")))
            .withColumn("low", F.when(over, F.col("low")).otherwise(F.col("tilt")))
        )
        # Newton on the logarithm, which is close to straight; a step that leaves the bracket
        # is replaced by its middle, or while one end is open by a doubled step.
        newton = F.col("tilt") - F.log(F.col("value") / F.col("target")) * F.col("value") / F.col("slope")
        inside = (newton > F.coalesce("low", F.lit(-math.inf))) & (newton < F.coalesce("high", F.lit(math.inf)))
        wide = F.lit(2.0) * F.abs("tilt") + 1
        middle = (
            F.when(F.col("low").isNull(), F.col("tilt") - wide)
            .when(F.col("high").isNull(), F.col("tilt") + wide)
            .otherwise((F.col("low") + F.col("high")) / 2)
        )
        moved = F.when(F.coalesce(inside, F.lit(False)), newton).otherwise(middle)
        done = F.col("gap") <= TOLERANCE
        state = materialise(
            step.withColumn("tilt", F.when(done | F.col("value").isNull(), F.col("tilt")).otherwise(moved)).select(*state.columns),
            "tilts",
        )
        worst = state.agg(F.max("gap")).first()[0]
        if worst is None or worst <= TOLERANCE:
            break
    return state


def whole_copies(sizes: DataFrame, tilts: DataFrame, most: int = MOST) -> DataFrame:
    """key, size, n and ``copies``, the whole copies that all n documents of a size get."""
    rates = (
        sizes.join(tilts.select("key", "target", "mean", "full", "none", "tilt"), "key")
        .withColumn("z", F.coalesce(F.col("size") / F.col("mean"), F.lit(0.0)))
        .withColumn("rate", F.when(F.col("size") == 0, F.lit(1.0)).otherwise(_rate(most)))
    )
    by_size = Window.partitionBy("key").orderBy("size")
    upto = F.sum(F.col("rate") * F.col("n")).over(by_size)
    rounded = F.floor(upto + 0.5)
    copies = rounded - F.coalesce(F.lag("rounded").over(by_size), F.lit(0))
    plan = (
        rates.withColumn("rounded", rounded)
        .withColumn("copies", F.least(F.greatest(copies, F.lit(0)), F.lit(most) * F.col("n")).cast("long"))
        .select("key", "target", "size", "n", "copies")
    )
    for _ in range(REPAIRS):
        plan = materialise(plan, "copies")
        missing = plan.groupBy("key").agg((F.max("target") - F.sum(F.col("size") * F.col("copies"))).alias("missing"))
        room = F.when(F.col("missing") > 0, F.col("copies") < F.lit(most) * F.col("n")).otherwise(F.col("copies") > 0)
        left = F.abs(F.abs("missing") - F.col("size"))
        best = (
            plan.join(missing, "key")
            .where((F.col("size") > 0) & room & (left < F.abs("missing")))
            .groupBy("key")
            .agg(F.min(F.struct(left.alias("left"), F.col("size").alias("at"), F.signum("missing").alias("sign"))).alias("best"))
            .select("key", "best.at", F.col("best.sign").cast("long").alias("sign"))
        )
        plan = plan.join(best, "key", "left").withColumn(
            "copies", F.col("copies") + F.when(F.col("size") == F.col("at"), F.col("sign")).otherwise(F.lit(0).cast("long"))
        ).drop("at", "sign")
    return plan


def _integer_share(copies: str, n: str, upto: str, own: str | None) -> Column:
    """Of ``copies`` dealt evenly to ``n``, those of the ``own`` (or one) that end at ``upto``."""
    before = f"(`{upto}` - {f'`{own}`' if own else '1'})"
    return F.expr(f"(`{copies}` * `{upto}`) div `{n}` - (`{copies}` * {before}) div `{n}`")


def mix(
    docs: DataFrame,
    source_col: str = "source",
    id_col: str = "doc_id",
    text_col: str = "text",
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    most: int = MOST,
) -> DataFrame:
    """``docs`` with mix_size, mix_source_size, mix_target and mix_copies (0 to ``most``).

    The four names get a trailing ``_`` where ``docs`` has them.
    """
    out = unused(docs, "mix_size", "mix_source_size", "mix_target", "mix_copies")
    key, salt, tie = unused(docs, "mix_key", "mix_salt", "mix_tie")
    size = out[0]
    rows = docs.withColumns(
        {key: source_key(F.col(source_col)), size: word_count(F.col(text_col)), tie: F.xxhash64(F.col(id_col), F.col(text_col))}
    ).withColumn(salt, F.pmod(F.col(tie), F.lit(SALTS)).cast("int"))
    salted = materialise(
        rows.groupBy(F.col(key).alias("key"), F.col(size).alias("size"), F.col(salt).alias("salt")).agg(F.count("*").alias("n")),
        "salted-sizes",
    )
    sizes = materialise(salted.groupBy("key", "size").agg(F.sum("n").alias("n")), "sizes")
    sources = materialise(
        targets(sizes.groupBy("key").agg(F.sum(F.col("size") * F.col("n")).alias("total")), weights, share, most), "targets"
    )
    plan = whole_copies(sizes, balance(sizes, sources, most), most)
    by_salt = Window.partitionBy("key", "size").orderBy("salt")
    dealt = (
        salted.join(plan.select("key", "size", F.col("n").alias("all"), F.col("copies").alias("of")), ["key", "size"])
        .withColumn("upto", F.sum("n").over(by_salt))
        .withColumn("copies", _integer_share("of", "all", "upto", "n"))
        .join(sources.select("key", "total", "target"), "key")
    )
    dealt = materialise(dealt.select("key", "size", "salt", "n", "copies", "total", "target"), "dealt")
    there, copies, total, target, place = unused(rows, "mix_n", "mix_of", out[1], out[2], "mix_place")
    dealt = dealt.toDF(key, size, salt, there, copies, total, target)
    ranked = Window.partitionBy(key, size, salt).orderBy(tie, id_col)
    return (
        rows.join(dealt, [key, size, salt])
        .withColumn(place, F.row_number().over(ranked).cast("long"))
        .withColumn(out[3], _integer_share(copies, there, place, None))
        .select(*(F.col(f"`{c}`") for c in docs.columns), size, total, target, out[3])
    )
