"""The registered queries of the corpus operators, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .bpe import bpe_round_trip
from .collocations import collocations, collocations_sql
from .common import table
from . import html_extract, toxicity
from .decontamination import leaks
from .embedding_join import near_vectors
from .mixing import assign, mix_totals, mixing_sql
from .ngram_join import ngram_jaccard
from .pii import find_personal_data
from .repeats import remove_repeats
from .spelling import spelling_variants, spelling_variants_sql
from .token_counts import token_counts
from .url_filter import url_filter, url_filter_sql


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts(table(spark, folder, "documents"), tokenizer("piece_bpe_32k.model"))


def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, folder, "labels")))


def op3_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op4_near_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return near_vectors(table(spark, folder, "embeddings"))


def op5_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return find_personal_data(table(spark, folder, "documents"))


def op6_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    return html_extract.extract(pages, html_extract.fit(pages))


def op7_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter(table(spark, folder, "pages"))


def op8_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_jaccard(table(spark, folder, "documents"))


def op9_suffix_repeats(spark: SparkSession, folder: str) -> DataFrame:
    return remove_repeats(table(spark, folder, "documents"))


def op10_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe_round_trip(table(spark, folder, "documents"), tokenizer("byte_bpe_50k.json"))


def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling_variants(table(spark, folder, "documents"))


def op12_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations(table(spark, folder, "documents"))


def op13_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mix_totals(assign(table(spark, folder, "documents")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_token_counts, op2_toxicity, op3_decontamination, op4_near_vectors, op5_personal_data, op6_html_extraction, op7_url_filter, op8_ngram_jaccard, op9_suffix_repeats, op10_bpe,
    op11_spelling_variants, op12_collocations, op13_mixing)}
ORACLES: dict[str, str] = {"op7_url_filter": url_filter_sql(), "op11_spelling_variants": spelling_variants_sql(), "op12_collocations": collocations_sql(), "op13_mixing": mixing_sql()}
