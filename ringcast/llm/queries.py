"""The registered queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ringcast.llm import oracle
from ringcast.llm.alignment import align_documents
from ringcast.llm.decontamination import item_digests
from ringcast.llm.filter_audit import audit_files, best_labels
from ringcast.llm.fingerprints import compare_edited
from ringcast.llm.language_id import identify_languages, train_languages
from ringcast.llm.licences import scan_licences, train_licences
from ringcast.llm.mixing import mix_sources
from ringcast.llm.near_dedup import near_classes
from ringcast.llm.pieces import token_digests
from ringcast.llm.quality_classifier import fit_quality, score_quality
from ringcast.llm.quality_rules import quality_rules
from ringcast.llm.tables import held_out, table
from ringcast.llm.toxicity import fit_toxicity, score_toxicity
from ringcast.llm.warc import archive_round_trip

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_near_dedup(spark, sf_dir):
    return near_classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id")


def language_network(docs, strange=False):
    return train_languages(docs.where(~held_out(F.col("doc_id"), 3, 1)), strange=strange)


@query
def op2_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = identify_languages(docs, language_network(docs), ["doc_id"])
    return found.withColumn("held_out", held_out(F.col("doc_id"), 3, 1))


@query
def op3_licences(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return scan_licences(docs, train_licences(docs))


@query
def op4_mix_sources(spark, sf_dir):
    return mix_sources(table(spark, sf_dir, "documents"))


@query
def op5_quality_rules(spark, sf_dir):
    return quality_rules(table(spark, sf_dir, "documents"), ["doc_id"])


def quality_model(spark, sf_dir, docs):
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return fit_quality(docs, labels.where(~held_out(F.col("doc_id"), 3, 1)))


@query
def op6_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = fit_toxicity(docs, labels.where(~held_out(F.col("doc_id"), 5, 0)))
    scored = score_toxicity(docs, model, ["doc_id"])
    return scored.withColumn("held_out", held_out(F.col("doc_id"), 5, 0))


@query
def op7_warc(spark, sf_dir):
    records = archive_round_trip(table(spark, sf_dir, "pages"))
    return records.select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@query
def op8_sentencepiece(spark, sf_dir):
    model_file = public_tokenizers.path("piece_bpe_32k.model")
    return token_digests(table(spark, sf_dir, "documents"), model_file, ["doc_id"])


@query
def op9_quality_classifier(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    scored = score_quality(docs, quality_model(spark, sf_dir, docs), ["doc_id"])
    return scored.withColumn("held_out", held_out(F.col("doc_id"), 3, 1))


@query
def op10_winnowing(spark, sf_dir):
    return compare_edited(table(spark, sf_dir, "documents"))


@query
def op11_filter_audit(spark, sf_dir):
    labels = best_labels(table(spark, sf_dir, "labels"))
    return audit_files(spark, f"{sf_dir}/documents.parquet", labels)


@query
def op12_alignment(spark, sf_dir):
    files = map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    docs = table(spark, sf_dir, "documents")
    return align_documents(docs, *files, public_tokenizers.PATTERN, ["doc_id"])


@query
def op13_decontamination(spark, sf_dir):
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return item_digests(docs, items)


def oracle_queries() -> dict[str, str]:
    return {
        "op4_mix_sources": oracle.MIXING,
        "op5_quality_rules": oracle.QUALITY_RULES,
        "op7_warc": oracle.WARC,
        "op11_filter_audit": oracle.FILTER_AUDIT,
        "op13_decontamination": oracle.DECONTAMINATION,
    }
