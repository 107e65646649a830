import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ringcast.llm import alignment
from ringcast.llm.alignment import align, align_documents, aligner, parts_of

FILES = [public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
A = Tokenizer.from_file(FILES[0])
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=FILES[1])
RAW = [open(f, "rb").read() for f in FILES]
OWN = aligner(*RAW, public_tokenizers.PATTERN)
BYTE_OF = alignment._byte_alphabet()
ODD = "a the é ß漢字🙂́  \n\t\r\xa0　<s><|endoftext|>_1'sLL\x00​ñ.▁"


def spelled(text):
    """Ids of both tokenizers and the bytes of each token, by the libraries."""
    a = A.encode(" " + text, add_special_tokens=False).ids
    b = B.encode(text)
    of_a = [bytes(BYTE_OF[c] for c in A.id_to_token(i)) for i in a]
    of_b = [
        bytes([int(B.id_to_piece(i)[3:5], 16)]) if B.is_byte(i)
        else B.id_to_piece(i).replace("▁", " ").encode()
        for i in b
    ]
    return a, b, of_a, of_b


def brute(texts):
    """Rows of the query: all pairs of tokens are compared by their byte ranges."""
    rows, corpus = [], Counter()
    for text in texts:
        a, b, of_a, of_b = spelled(text or "")
        joined = (" " + (text or "")).encode()
        if not text or b"".join(of_a) != joined or b"".join(of_b) != joined:
            rows.append(None)
            continue
        ends_a, ends_b = np.cumsum([len(x) for x in of_a]), np.cumsum([len(x) for x in of_b])
        begins_a, begins_b = ends_a - [len(x) for x in of_a], ends_b - [len(x) for x in of_b]
        links = [
            (x, y) for i, x in enumerate(a) for j, y in enumerate(b)
            if begins_a[i] < ends_b[j] and begins_b[j] < ends_a[i]
        ]
        corpus.update(links)
        cuts = [0, *sorted(set(ends_a.tolist()) & set(ends_b.tolist()))]
        groups = [
            ",".join(str(x) for x, e in zip(a, ends_a) if p < e <= q) + "|"
            + ",".join(str(x) for x, e in zip(b, ends_b) if p < e <= q)
            for p, q in zip(cuts, cuts[1:])
        ]
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
        rows.append((len(a), len(b), len(groups), links, digest))
    most = Counter()
    for (_, y), n in corpus.items():
        most[y] = max(most[y], n)
    return [
        (0, 0, 0, 0, "", 0, 0) if r is None else (
            *r[:3], len(r[3]), r[4],
            sum(corpus[x] == most[x[1]] for x in r[3]), sum(corpus[x] for x in r[3]),
        )
        for r in rows
    ]


def result(spark, rows, **named):
    docs = spark.createDataFrame(
        [(k, t, "x", 3, [1]) for k, t in rows],
        "doc_id long, text string, pair string, _row int, times array<int>",
    )
    got = align_documents(docs, *FILES, public_tokenizers.PATTERN, ["doc_id"], **named)
    names = "doc_id n_a n_b n_groups n_links groups_sha256 n_best count_sum".split()
    return sorted((tuple(r) for r in got.select(names).collect()), key=str)


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(max_size=60), st.text(alphabet=ODD, max_size=80)))
def test_ids_equal_the_libraries(text):
    if text:
        a, b = A.encode(" " + text, add_special_tokens=False).ids, B.encode(text)
        assert OWN.a.encode(" " + text) == a
        if "▁" not in text:
            assert OWN.b.encode(" " + text).tolist() == b


@settings(max_examples=400, deadline=None)
@given(st.integers(1, 400), st.data())
def test_irregular_groups_are_those_between_common_ends(n, data):
    a = sorted({*data.draw(st.lists(st.integers(1, n), max_size=n)), n})
    flip = data.draw(st.lists(st.integers(1, n), max_size=8))
    b = sorted({*(set(a) ^ set(flip)), n})
    ends = [np.array(x, np.int32) for x in (a, b)]
    cuts = [0, *sorted(set(a) & set(b))]
    wanted = []
    for p, q in zip(cuts, cuts[1:]):
        i, j = [(np.searchsorted(e, p, "right"), np.searchsorted(e, q) + 1) for e in ends]
        if (i[1] - i[0], j[1] - j[0]) != (1, 1):
            wanted.append((*map(int, i), *map(int, j)))
    assert align(*ends) == wanted


def test_equals_brute_force_over_all_pairs(spark):
    rng = random.Random(5)
    rows = [(i, "".join(rng.choices(ODD + "eeeettta", k=rng.randint(0, 60)))) for i in range(60)]
    rows += [(60, None), (61, ""), (None, "null key"), (7, "twice the same"), (7, "twice the same"),
             (62, "a▁b"), (63, "  lead and trail  "), (64, "<|endoftext|> is plain text")]
    wanted = sorted(((k, *r) for (k, _), r in zip(rows, brute([t for _, t in rows]))), key=str)
    assert result(spark, rows) == wanted
    assert result(spark, rows, most_pairs=40) == wanted  # in several blocks


def test_documents_of_the_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    texts = {r.doc_id: r.text for r in docs.collect() if len(r.text or "") < 1200}
    wanted = sorted(((k, *r) for k, r in zip(texts, brute(list(texts.values())))), key=str)
    assert result(spark, list(texts.items())) == wanted


def test_long_texts_in_parts(monkeypatch):
    rng = random.Random(6)
    words = ["the", "Straße", "漢字", "x" * 30, "\n", "  ", "\t\t", "it's", "1,000", "\r\n", "\xa0"]
    text = " ".join(rng.choices(words, k=4000))
    whole = OWN.document(text)
    monkeypatch.setattr(alignment, "PART", 50)
    assert len(parts_of(text)) > 100 and "".join(parts_of(text)) == " " + text
    in_parts = OWN.document(text)
    assert whole[:5] == in_parts[:5]
    for x, y in zip(whole[5:], in_parts[5:], strict=True):
        np.testing.assert_array_equal(x, y)
    assert len(OWN.groups(text)) == whole[2]


@pytest.mark.parametrize("text", ["q" * 300_000, "ab " * 150_000, "漢" * 50_000])
def test_very_long_texts(text):
    a, b = A.encode(" " + text, add_special_tokens=False).ids, B.encode(text)
    made = OWN.document(text)
    assert made[:2] == (len(a), len(b))
    assert made[3] == made[0] + made[1] - made[2] == int(np.sum(made[6]))


def test_an_empty_table(spark):
    assert result(spark, []) == []
