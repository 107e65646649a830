"""From raw documents to token counts of a mixed corpus, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all rows of ``docs``; all but the
last return the columns of documents.  Stages that learn take labels, or the language
column, of the rows that the queries of the same operators learn from.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ringcast.llm.language_id import UNDETERMINED, identify_languages
from ringcast.llm.mixing import mixed
from ringcast.llm.near_dedup import near_distinct
from ringcast.llm.pieces import token_digests
from ringcast.llm.quality_classifier import score_quality
from ringcast.llm.queries import language_network, quality_model
from ringcast.llm.tables import table
from ringcast.session import stage


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; an empty table stays empty."""
    if docs.isEmpty():
        return docs
    model = quality_model(spark, sf_dir, docs)
    scored = score_quality(docs, model, docs.columns, prefix="_")
    return scored.where("_predicted = 1").select(docs.columns)


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the learned languages; an empty table stays empty.

    Letter noise and languages that were not learned go, by a bar that the network takes
    from learning rows kept aside.
    """
    if docs.isEmpty():
        return docs
    network = language_network(docs, strange=True)
    found = identify_languages(docs, network, docs.columns, prefix="_")
    return found.where(F.col("_lang_pred") != UNDETERMINED).select(docs.columns)


def keep_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return near_distinct(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixed(docs)


def count_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Numbers of tokens, and digests of the tokens and what they decode to."""
    return token_digests(docs, public_tokenizers.path("piece_bpe_32k.model"), ["doc_id"])


STAGES = [
    ("quality classifier", keep_good),
    ("language id", keep_languages),
    ("near duplicates", keep_distinct),
    ("source mix", mix),
    ("token counts", count_tokens),
]

#: Trained models and hashed samples decide what is kept, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
