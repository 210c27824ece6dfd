"""A corpus pipeline in five stages over ``documents``; every stage works on all rows that the one before it kept.

Stages return the columns of documents, the last one token counts and hashes. Rows that a stage rejects go; near
duplicates keep the document with the smallest id of each group; personal data is replaced by its kind.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tenura.llm import toxicity
from tenura.llm.bpe import bpe_round_trip
from tenura.llm.common import table, written
from tenura.llm.decontamination import without_leaks
from tenura.llm.ngram_join import ngram_jaccard, with_signatures
from tenura.llm.pii import masked
from tenura.llm.queries import tokenizer


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Train on the labelled ones of these documents and drop what scores 0.5 or more."""
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")), keep=True)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group that five-word shingles link at 0.8: the smallest id; of equal ids the smallest text.

    Rows without an id or without words are in no group and stay, and so does a further text under the same id that is
    no near duplicate of anything.
    """
    found = written(ngram_jaccard(docs, words=5, num=80, den=100, nodes=True))
    repeated = written(found.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id"))
    gone = written(found.where("doc_id <> component_id").select("doc_id").join(repeated, "doc_id", "left_anti").distinct())
    kept = docs.join(gone, "doc_id", "left_anti").select(docs.columns)
    if repeated.isEmpty():
        return kept
    # where an id stands on several rows, each is decided by the set of its own text
    again = with_signatures(docs.join(repeated, "doc_id", "left_semi").select(docs.columns), 5, "__node")
    named = found.where("doc_id = component_id and n_shingles > 0").join(repeated, "doc_id", "left_semi")
    named = named.select(F.col("doc_id").alias("__id"), F.col("node").alias("__set"), F.col("component").alias("__component")).distinct()
    own = again.join(named, (F.col("doc_id") == F.col("__id")) & (F.col("__node") == F.col("__set")))
    order = ["text", *[c for c in docs.columns if c != "text"]]
    firsts = own.groupBy("__component").agg(F.min(F.struct(*order)).alias("__row")).select(*[F.col("__row")[c].alias(c) for c in docs.columns])
    single = kept.join(repeated, "doc_id", "left_anti").select(docs.columns)
    return single.unionByName(firsts).unionByName(again.where("__node = 0").select(docs.columns))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item within the edit budget."""
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace every span of personal data by its kind; n_chars follows the new text."""
    columns = docs.columns
    out = masked(docs)
    if "n_chars" in columns:
        out = out.withColumn("n_chars", F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), F.col("n_chars")))
    return out.select(columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and hashes of the ids and of the decoded text."""
    return bpe_round_trip(docs, tokenizer("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near duplicates", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("personal data", mask_personal_data),
    ("byte-pair encoding", encode),
]
#: SQL expresses neither the trained stages nor the encoding; tests/llm compares them with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = written(docs)
    return docs
