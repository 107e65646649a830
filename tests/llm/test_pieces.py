import hashlib

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from ringcast.llm import pieces
from ringcast.llm.pieces import decode_ids, encode_texts, model_of, token_digests

FILE = public_tokenizers.path("piece_bpe_32k.model")
with open(FILE, "rb") as f:
    MODEL = model_of(f.read())
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=FILE)


@settings(max_examples=600, deadline=None)
@given(
    st.one_of(
        st.text(max_size=60),
        st.text(alphabet=" ▁\n\tabceinorst<s>0xA.é漢🙂́", max_size=80),
        st.text(alphabet="aeinorst ", max_size=200),
    )
)
def test_ids_equal_the_library(text):
    ids = LIBRARY.encode(text)
    assert MODEL.encode(text) == ids
    assert MODEL.decode(ids) == LIBRARY.decode(ids)
    assert MODEL.digest(text) == (
        len(ids),
        hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
        hashlib.sha256(LIBRARY.decode(ids).encode()).hexdigest(),
    )


def test_frequent_runs_stay_in_a_full_cache(monkeypatch):
    monkeypatch.setattr(pieces, "CACHED_RUNS", 8)
    with open(FILE, "rb") as f:
        model = pieces.PieceModel(f.read())
    asked, encode_run = [], model.encode_run
    monkeypatch.setattr(model, "encode_run", lambda run: asked.append(run) or encode_run(run))
    text = " ".join(f"often w{i}" for i in range(40))
    assert model.digest(text)[0] == len(LIBRARY.encode(text))
    assert asked.count("▁often") == 1 and len(asked) == 41
    assert len(model._runs) + len(model._runs.older) <= 8


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 400), st.integers(0, 31999)), max_size=12))
def test_any_ids_decode_as_the_library(ids):
    assert MODEL.decode(ids) == LIBRARY.decode(ids)


def test_queries_on_nulls_clashing_names_and_empty_tables(spark):
    rows = [(1, None, 5, "x"), (2, "", 6, "y"), (2, "a" * 5000 + " b", 7, None), (None, "é\x00", 8, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int, ids string")
    got = token_digests(docs, FILE, ["doc_id"]).collect()
    wanted = []
    for i, text, *_ in rows:
        ids = LIBRARY.encode(text or "")
        h = [hashlib.sha256(x.encode()).hexdigest()
             for x in (",".join(map(str, ids)), LIBRARY.decode(ids))]
        wanted.append((i, len(ids), *h))
    key = str
    assert sorted(map(tuple, got), key=key) == sorted(wanted, key=key)
    assert token_digests(docs.limit(0), FILE, ["doc_id"]).count() == 0
    back = decode_ids(encode_texts(docs, FILE, ["doc_id"]), FILE, ["doc_id"]).collect()
    assert sorted((r.text for r in back)) == sorted((t or "") for _, t, *_ in rows)


def test_every_document_of_the_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    for r in token_digests(docs, FILE, ["doc_id"]).collect():
        ids = LIBRARY.encode(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        decoded = LIBRARY.decode(ids)
        assert r.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_other_models_are_refused():
    with pytest.raises(ValueError):
        model_of(b"\x12\x02\x18\x01")
