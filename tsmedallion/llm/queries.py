"""One query per operator, over the whole of its table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tsmedallion.llm import (
    alignment,
    chat_trees,
    decontaminate,
    hamming_search,
    language_id,
    lexical_search,
    license_scan,
    line_dedup,
    mixing,
    quality,
    secrets,
    simhash_dedup,
    token_counts,
)
from tsmedallion.llm.common import table
from tsmedallion.session import scratch_path

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
BYTE_LEVEL = "/opt/tokenizers/byte_bpe_50k.json"
RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Texts that hold the marks of the template themselves.
PROBE = [(-7, turn, role, r"\### Assistant: </turn> ok") for turn, role in enumerate(("user", "assistant"))]
NEIGHBOURS = 10
QUERY_STEP = 20

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


@query
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = token_counts.load_pieces(VOCABULARY)
    return token_counts.token_counts(table(spark, sf_dir, "documents"), pieces)


@query
def op2_hamming_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queries are the rows whose id is divisible by 20; codes are the signs of the vectors."""
    vectors = table(spark, sf_dir, "embeddings")
    codes = vectors.select(F.col("vec_id").alias("id"), hamming_search.sign_code(F.col("embedding")).alias("code"))
    return hamming_search.hamming_top_k(codes, codes.where(F.col("id") % QUERY_STEP == 0), NEIGHBOURS)


def _listed(spans: Column, kinds: list[str]) -> tuple[Column, Column]:
    """Spans of ``kinds`` as text, by start, then by the order of the kinds; and their number."""
    kind = lambda s: F.element_at(F.split(s.rule, "@"), 1)
    own = F.filter(spans, lambda s: kind(s).isin(*kinds))
    place = lambda s: F.array_position(F.array(*map(F.lit, kinds)), kind(s))
    keyed = F.transform(
        own,
        lambda s: F.struct(
            s.start.alias("start"),
            place(s).alias("place"),
            s.end.alias("end"),
            F.concat_ws(":", kind(s), s.start.cast("string"), s.end.cast("string")).alias("text"),
        ),
    )
    return F.array_join(F.transform(F.array_sort(keyed), lambda s: s.text), ","), F.size(own).cast("long")


@query
def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    ledger = secrets.BlobLedger(spark, scratch_path(spark, "blob-ledger"))
    found = secrets.scan(docs, ledger, path_col="doc_id")
    base, more = ([r.kind for r in rules] for rules in (secrets.BASE, secrets.RULES))
    count = {k: _listed(F.col("spans"), [k])[1] for k in base}
    return found.select(
        "doc_id",
        *(count[k].alias(f"n_{k}") for k in base),
        F.sha2(_listed(F.col("spans"), base)[0], 256).alias("base_sha256"),
        _listed(F.col("spans"), more)[0].alias("spans"),
    )


@query
def op4_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
    )


@query
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.withColumn("keep", F.col("score") >= 0.5)


@query
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    found = line_dedup.drop_boilerplate(docs, dropped_col="n_dropped")
    return found.select("doc_id", "n_dropped", F.md5("text").alias("text_md5"))


@query
def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.license_scan(table(spark, sf_dir, "documents"))
    labels = lambda spans: F.transform(spans, lambda s: s.label)
    joined = lambda names: F.array_join(F.array_sort(F.array_distinct(names)), ",")
    first = F.transform("base", lambda s: s.first)
    own, base = labels(F.col("accepted")), labels(F.col("base"))
    return found.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(first).alias("first_word"),
        F.array_max(first).alias("last_word"),
        joined(base).alias("base_labels"),
        joined(F.concat(base, own)).alias("labels"),
        F.when(F.size("accepted") > 0, 1.0).when(F.size("base") > 0, 0.5).otherwise(0.0).alias("score"),
    )


@query
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixed.select(
        "doc_id",
        F.col("mix_size").alias("size"),
        F.col("mix_source_size").alias("source_size"),
        F.col("mix_target").alias("target"),
        (F.col("mix_size") * F.col("mix_copies")).alias("taken"),
        F.col("mix_copies").alias("copies"),
    )


@query
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per document and benchmark item found in it; clean documents have none."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = decontaminate.mark_leaks(docs, table(spark, sf_dir, "benchmark"))
    return marked.select("doc_id", F.inline("leaks"))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


@query
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.train(docs.where(~held_out(F.col("doc_id"))))
    found = language_id.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query
def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.lexical_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), NEIGHBOURS)


@query
def op12_chat_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame(PROBE, turns.schema)
    packs = chat_trees.pack_conversations(turns.unionByName(probe), RANKS)
    return chat_trees.read_back(packs, RANKS)


@query
def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = alignment.align(table(spark, sf_dir, "documents"), BYTE_LEVEL, VOCABULARY).documents
    return found.withColumnRenamed("id", "doc_id")


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)
