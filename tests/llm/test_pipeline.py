import random

import duckdb
import public_tokenizers
import pytest
import sentencepiece

import corpus_pipeline
from ringcast.llm import oracle
from ringcast.llm.quality_classifier import score_quality
from ringcast.llm.queries import language_network, quality_model
from ringcast.llm.language_id import identify_languages
from tests.llm.test_near_dedup import brute_classes


def test_pipeline_against_its_parts(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = {r.doc_id: r.text for r in docs.collect()}
    model = quality_model(spark, sf, docs)
    good = {r.doc_id for r in score_quality(docs, model, ["doc_id"]).where("score >= 0.5").collect()}
    first = docs.where(docs.doc_id.isin(sorted(good)))
    found = identify_languages(first, language_network(first, strange=True), ["doc_id"]).collect()
    known = {r.doc_id for r in found if r.lang_pred != "und"}
    single = {c for _, c in brute_classes([(i, rows[i]) for i in sorted(known)])}

    documents = docs.where(docs.doc_id.isin(sorted(single))).toPandas()
    connection = duckdb.connect()
    connection.register("documents", documents)
    taken = connection.execute(f"select doc_id, copies from ({oracle.MIXING})").fetchall()
    library = sentencepiece.SentencePieceProcessor(
        model_file=public_tokenizers.path("piece_bpe_32k.model")
    )
    wanted = sorted((i, len(library.encode(rows[i] or ""))) for i, n in taken for _ in range(n))
    got = sorted((r.doc_id, r.n_tokens) for r in corpus_pipeline.run(spark, sf).collect())
    assert got == wanted
    assert len(good) < len(rows) and len(single) < len(known)


STRANGE = {
    "it": "Il governo ha annunciato ieri una nuova legge che riguarda le scuole pubbliche della "
    "regione. Gli insegnanti chiedono maggiori risorse e gli edifici hanno bisogno di lavori.",
    "tr": "Dün akşam şehirde büyük bir yağmur yağdı ve birçok sokak sular altında kaldı. İnsanlar "
    "evlerine ulaşmak için uzun süre beklemek zorunda kaldılar.",
    "fi": "Eilen illalla kaupungissa satoi rankasti ja monet kadut jäivät veden alle. Ihmiset "
    "joutuivat odottamaan busseja pitkään.",
    "ru": "Вчера вечером в городе прошёл сильный дождь, и многие улицы оказались под водой.",
    "ja": "昨日の夜、町では大雨が降り、多くの道が水に浸かりました。人々は長い間待ちました。",
    "noise": " ".join(
        "".join(random.Random(i).choices("abcdefghijklmnopqrstuvwxyz", k=2 + i % 8)) for i in range(80)
    ),
}


def test_language_stage_rejects_noise_and_languages_not_learned(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").where("rlike(text, '[a-z]')")
    rows = [(10**9 + i, text, None, "planted", len(text)) for i, text in enumerate(STRANGE.values())]
    whole = docs.unionByName(spark.createDataFrame(rows, docs.schema))
    kept = {r.doc_id for r in corpus_pipeline.keep_languages(spark, whole, sf).select("doc_id").collect()}
    assert not kept & {r[0] for r in rows}
    clean = {r.doc_id for r in docs.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("quality = 1").collect()}
    assert len(clean - kept) <= len(clean) // 500


def test_stages_keep_the_columns(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    names = docs.columns
    for _, apply in corpus_pipeline.STAGES[:-1]:
        docs = apply(spark, docs, sf)
        assert docs.columns == names


@pytest.mark.parametrize("place", range(5))
def test_stages_on_an_empty_table(spark, sf, place):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(0)
    assert corpus_pipeline.STAGES[place][1](spark, docs, sf).count() == 0
