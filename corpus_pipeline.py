"""A corpus cleaned and mixed in five stages, each one operator of ``tsmedallion.llm``.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as Parquet
to the shared scratch folder and hands what it reads back to the next one. All columns of
``documents`` go through, further ones too. The last stage adds those of the mix.

Empty tables give empty results; rows with nulls are treated as each operator says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tsmedallion.llm import decontaminate, language_id, line_dedup, mixing, simhash_dedup
from tsmedallion.llm.common import table, unused
from tsmedallion.session import materialise, scratch_path, scratch_scope

LEAST_LANGUAGE_SCORE = 1 / 3


def _only(docs: DataFrame, columns: list[str]) -> DataFrame:
    return docs.select(*(F.col(f"`{c}`") for c in columns))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts without letters and those whose main language has under a third of the letters.

    Letters in scripts or stretches that fit no learned language count for none.

    Learns from all rows that have a language. If none has, nothing can be judged and only
    texts without letters go.
    """
    names = unused(docs, "lang_pred", "score", "lang_spans")
    model = language_id.train(docs)
    if not model.languages:
        return docs.where(F.coalesce(F.regexp_count("text", F.lit(r"\p{L}")), F.lit(0)) > 0)
    found = language_id.identify(docs, model, columns=tuple(names))
    fits = (F.col(names[0]) != language_id.UNDETERMINED) & (F.col(names[1]) >= LEAST_LANGUAGE_SCORE)
    return _only(found.where(fits), docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops boilerplate lines by source; ``n_chars`` follows the text. No row goes."""
    (dropped,) = unused(docs, "dropped")
    cleaned = line_dedup.drop_boilerplate(docs, dropped_col=dropped)
    if "n_chars" not in docs.columns:
        return _only(cleaned, docs.columns)
    size = F.when(F.col(dropped) > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return _only(cleaned.withColumn("n_chars", size), docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates, that with the smallest id."""
    return simhash_dedup.one_of_each(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that contain a passage of the benchmark."""
    (leaks,) = unused(docs, "leaks")
    marked = decontaminate.mark_leaks(docs, table(spark, sf_dir, "benchmark"), matches_col=leaks)
    return _only(marked.where(F.size(leaks) == 0), docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for every copy that the mix takes of a document, numbered from 1."""
    mixed = mixing.mix(docs)
    size, total, target, copies = mixed.columns[-4:]
    (copy,) = unused(mixed, "mix_copy")
    taken = mixed.where(F.col(copies) > 0)
    return taken.select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col(copies))).alias(copy))


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("mixing", mix_sources),
]

# SimHash components and the dual of the mix are fixed points that SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage. The tables that stages wrote go at the end, but for that one."""
    *earlier, (last, mix) = STAGES
    result = scratch_path(spark, f"stage-{last}")
    with scratch_scope(spark):
        docs = table(spark, sf_dir, "documents")
        for name, stage in earlier:
            docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
        mixed = mix(spark, docs, sf_dir)
        mixed.write.parquet(result)
    return spark.read.schema(mixed.schema).parquet(result)
