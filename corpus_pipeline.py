"""The corpus pipeline: stages over documents, each writing what the next one reads.

Rows alike in every column count as one document from the near-duplicate stage on; a document
that the mix uses twice leaves it as two rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimstream.llm import automaton, mixing, quality, sharding, simhash
from claimstream.llm.common import free_name, held_out, table
from claimstream.session import fresh_path

SHARDS = 24


def _set_apart(docs: DataFrame, *names: str) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` without columns of these names, and how to name them back."""
    renamed = {c: f"_own_{c}" for c in docs.columns if c in names}
    return docs.withColumnsRenamed(renamed), {v: k for k, v in renamed.items()}


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality classifier accepts; labels teach it, they do not decide."""
    labels = table(spark, sf_dir, "labels").where(~held_out(F.col("doc_id")))
    machine = quality.train(docs, labels, "doc_id", "text", "quality")
    score = free_name(docs, "_quality")
    scored = quality.scored(docs, "text", machine, score)
    return scored.where(F.col(score) >= quality.ACCEPT).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id."""
    return simhash.survivors(docs, "doc_id", "text").select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth stands in benchmark items, as they are."""
    rows, back = _set_apart(
        docs, "n_words", "hit_spans", "hit_items", "n_hit", "n_items", "contaminated"
    )
    items = table(spark, sf_dir, "benchmark")
    judged = automaton.judged(automaton.hits(rows, "text", items, "item_id", "text"))
    return judged.where(~F.col("contaminated")).select(*rows.columns).withColumnsRenamed(back)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, each as often as the mix uses it."""
    size, members = mixing.word_count(F.col("text")), F.array("source")
    mixed, _ = mixing.mixed(docs, "doc_id", size, members, whole=True)
    used = mixed.where("copies > 0")
    each = used.select("document", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return each.select("document.*").select(*docs.columns)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every row of the mix."""
    return sharding.assign(docs, "doc_id", "text", SHARDS)


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", shard),
]

# The first stage is a trained model, which SQL cannot express; tests/llm compares the stages
# with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = fresh_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
