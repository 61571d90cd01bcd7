"""From raw documents to a mixed, encoded training corpus, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet to the shared folder and read
again as the next one's ``docs``. All but the last return the columns of ``documents``; the last adds the piece ids.
Nothing here can be stated in SQL as a whole (compression, trained dictionaries, piece encoding), so ``ORACLE_SQL`` is
None and the tests compare the stages with brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coursepulse.llm import exact, language, mixing, nearcopies, pieces
from coursepulse.llm.queries import model_path
from coursepulse.llm.shared import free_name, stage

ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents whose language is rejected."""
    return language.keep_identified(docs, language.fit(docs))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one row, of the smallest id; rows without an id go when another has one."""
    return exact.keep_first(docs, unnamed=False)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-copies one row, of the smallest id. Five words, a similarity of 0.8."""
    return nearcopies.keep_one(docs, percent=80, by_row=True)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, by the weights of their sources."""
    return mixing.mixed_documents(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds pieces, the ids of the text, and n_pieces; underscores follow the names if the documents have such columns."""
    ids, number = free_name(docs, "pieces"), free_name(docs, "n_pieces")
    encoded = pieces.encode(docs, pieces.read_model(model_path()), out=ids)
    return encoded.withColumn(number, F.size(ids))


STAGES = [
    ("language", identify_language),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mix", mix_sources),
    ("pieces", encode_pieces),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name)
    return docs
