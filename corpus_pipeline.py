"""A training corpus from raw documents: five stages, each written and read again.

Quality, near-duplicates, benchmark passages, personal data, mixture. Every stage
works on all that its predecessor kept.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from threadloom.llm.common import free_name, table, word_count
from threadloom.llm.decontaminate import benchmark_hits, contaminated
from threadloom.llm.mixing import mix_sources
from threadloom.llm.near_dup import near_duplicates
from threadloom.llm.pii import pseudonymise
from threadloom.llm.quality import THRESHOLD, learn, quality_scores
from threadloom.session import store


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality classifier accepts. Empty texts are scored like any other."""
    model = learn(docs, table(spark, sf_dir, "labels"))
    score = free_name(docs, "score")
    scored = quality_scores(docs, model, name=score)
    return scored.where(F.col(score) >= THRESHOLD).drop(score)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that of the smallest id.

    A document is an id and a text: of rows that repeat both, that of the smallest
    source, then lang, then hash of all columns stays, nulls first; other texts of
    an id are documents of their own. Of texts of one id in a group, that of the
    smallest hash stays. Documents without an id are compared like the others; as
    none of them can be named by a smallest id, one of each group stays beside
    the one with an id. Texts without words are in no group.
    """
    key = free_name(docs, "row_key")
    keyed = docs.withColumn(key, F.xxhash64(F.col("doc_id").isNull(), "doc_id", "text"))
    groups = store(
        near_duplicates(keyed, doc_id=key, carry="doc_id")
        .where("n_shingles > 0")
        .select(
            "component_id", F.col("carried").isNull().alias("unnamed"),
            F.struct(F.col("carried").alias("id"), F.col("doc_id").alias("key")).alias("rank"),
        ),
        "groups",
    )
    first = (
        groups.groupBy("component_id", "unnamed")
        .agg(F.min("rank").alias("first"), F.max("rank").alias("last"))
        .where("first <> last")
        .drop("last")
    )
    gone = store(
        groups.join(first, ["component_id", "unnamed"])
        .where(F.col("rank") > F.col("first"))
        .select(F.col("rank.key").alias(key)),
        "gone",
    ).distinct()
    hashed = free_name(docs, "row_hash")
    kept = keyed.join(gone, key, "left_anti").withColumn(hashed, F.xxhash64(*docs.columns))
    rank = F.struct(*[F.col(c) for c in ("source", "lang") if c in docs.columns], F.col(hashed))
    repeated = store(
        kept.groupBy(key)
        .agg(F.count(F.lit(1)).alias("_rows"), F.min(rank).alias("_first"))
        .where("_rows > 1")
        .select(key, F.col(f"_first.{hashed}").alias("_first")),
        "repeated",
    )
    # Only rows whose id and text repeat are shuffled whole.
    single = kept.join(repeated, key, "left_anti").select(docs.columns)
    several = kept.join(repeated, key).where(F.col(hashed) == F.col("_first")).dropDuplicates([key])
    return single.unionByName(several.select(docs.columns))


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    hits = free_name(docs, "hits")
    found = benchmark_hits(docs, table(spark, sf_dir, "benchmark"), name=hits)
    return found.where(~contaminated(hits)).drop(hits)


def hide_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by pseudonyms; n_chars follows the text."""
    hidden = pseudonymise(docs)
    if "n_chars" not in docs.columns:
        return hidden
    length = F.char_length("text").cast(docs.schema["n_chars"].dataType)
    return hidden.withColumn("n_chars", F.coalesce(length, F.col("n_chars"))).select(docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the mix takes, with size, source_size, target, copies and taken.

    Columns of those names in ``docs`` give way to the new ones. Rows that are equal in every column become one row with the copies of all.
    """
    kept = [c for c in docs.columns if c not in {"size", "source_size", "target", "copies", "taken"}]
    docs = docs.select(kept)
    key = free_name(docs, "row_key")
    keyed = docs.withColumn(key, F.xxhash64(*kept))
    sized = store(keyed.select("doc_id", key, "source", word_count(F.col("text")).alias("size")), "sized")
    drawn = (
        mix_sources(sized, ids=("doc_id", key))
        .groupBy("doc_id", key)
        .agg(
            F.first("size").alias("size"), F.first("source_size").alias("source_size"),
            F.first("target").alias("target"), F.sum("copies").alias("copies"),
            F.sum("taken").alias("taken"),
        )
        .where("copies > 0")
        .withColumnRenamed("doc_id", "_id")
    )
    return (
        keyed.dropDuplicates([key, "doc_id"])
        .join(drawn, (keyed[key] == drawn[key]) & keyed["doc_id"].eqNullSafe(drawn["_id"]))
        .select(*[keyed[c] for c in kept], "size", "source_size", "target", "copies", "taken")
    )


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality", keep_good),
    ("near_duplicates", drop_near_duplicates),
    ("benchmark", drop_benchmark),
    ("private", hide_private),
    ("mix", mix),
]

# Learnt scores, sketches and random draws are not SQL; the stages are tested by themselves.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), name)
    return docs
