"""A corpus from raw documents: language, exact copies, near copies, benchmark text, mix.

Each stage reads what the one before it wrote; all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import decontaminate, exact_dedup, language_id, mixing, near_dedup
from strata.llm.shared import stored


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language: those without a letter are rejected. A language other than the
    labelled one is no reason to drop a document, nor is it that no language could be learned; the
    columns stay as they are."""
    model = language_id.train(docs)
    if not model.languages:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    own = [f"_doc_{i}" for i in range(len(docs.columns))]
    renamed = docs.select(*[docs[c].alias(n) for c, n in zip(docs.columns, own)])
    text = own[docs.columns.index("text")]
    found = language_id.predict_language(renamed, model, text)
    kept = found.filter(F.col("lang_pred") != language_id.UNDETERMINED)
    return kept.select(*[F.col(n).alias(c) for c, n in zip(docs.columns, own)])


def drop_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.drop_exact_duplicates(docs)


def drop_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by shingles of five words at similarity 0.8."""
    return near_dedup.drop_near_duplicates(docs, n=5, percent=80)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of ten words (or a whole shorter item) of the benchmark."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.remove_contamination(docs, benchmark)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix takes them, numbered by ``copy``."""
    return mixing.apply_mix(docs)


STAGES = [
    ("language", keep_known_languages),
    ("exact", drop_exact),
    ("near", drop_near),
    ("benchmark", drop_benchmark),
    ("mix", mix),
]

#: Neither cross-parsing nor balanced rounding is a query; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
