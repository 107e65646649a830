"""Held-out accuracy and edge cases of the trained operators."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ringcast.llm.language_id import (
    SPAN,
    ByteNetwork,
    identify_languages,
    language_spans,
    train_languages,
)
from ringcast.llm.quality_classifier import FactorisationMachine, fit_quality, score_quality
from ringcast.llm.queries import QUERIES
from ringcast.llm.tables import held_out
from ringcast.llm.texts import Texts
from ringcast.llm.toxicity import (
    CharacterModel,
    fit_toxicity,
    lattice_of,
    restore,
    restored_text,
    score_toxicity,
)

BIG = "/root/testdata/sf0.01"
ODD = [
    (1, None, "x", None, None, 1, "a", True),
    (2, "", "x", 0, None, 1, "a", True),
    (2, "", "x", 0, None, 1, "a", True),
    (3, " \n ", None, 3, "s", 1, "a", True),
    (None, "the of and that " * 20000, "en", None, "s", 1, "a", True),
    (4, "123 !!! ---", None, 11, None, 1, "a", True),
    (5, "é", None, None, None, None, None, None),
]
ODD_SCHEMA = (
    "doc_id long, text string, lang string, n_chars long, source string, "
    "predicted int, lang_pred string, held_out boolean"
)


def accuracy(spark, query, label, fold):
    labels = spark.read.parquet(f"{BIG}/labels.parquet").select("doc_id", F.col(label).alias("y"))
    out = QUERIES[query](spark, BIG)
    rows = out.join(labels, "doc_id").where(f"y is not null and {fold}").collect()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    return np.mean([r.predicted == r.y for r in rows])


@pytest.mark.parametrize("query, label", [("op9_quality_classifier", "quality"), ("op6_toxicity", "toxic")])
def test_held_out_accuracy(spark, query, label):
    assert accuracy(spark, query, label, "held_out") > 0.95


def test_held_out_languages(spark):
    docs = spark.read.parquet(f"{BIG}/documents.parquet").select("doc_id", "lang")
    rows = QUERIES["op2_language_id"](spark, BIG).join(docs, "doc_id").where("held_out").collect()
    assert np.mean([r.lang_pred == r.lang for r in rows if r.lang]) > 0.97


def test_folds(spark):
    import zlib

    ids = spark.createDataFrame([(i,) for i in [*range(50), -7, None]], "doc_id long")
    for r in ids.withColumn("h", held_out(F.col("doc_id"), 3, 1)).collect():
        assert r.h == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)


@pytest.fixture(scope="module")
def labelled(spark):
    docs = spark.read.parquet(f"{BIG}/documents.parquet")
    return docs, spark.read.parquet(f"{BIG}/labels.parquet")


def test_odd_rows(spark, labelled):
    docs, labels = labelled
    odd = spark.createDataFrame(ODD, ODD_SCHEMA)
    scorers = [
        (score_quality, fit_quality(docs, labels)),
        (score_toxicity, fit_toxicity(docs, labels)),
    ]
    for score, model in scorers:
        rows = score(odd, model, ["doc_id"]).collect()
        assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
        assert rows[1] == rows[2]
        assert score(odd.limit(0), model, ["doc_id"]).count() == 0
    net = train_languages(docs)
    rows = identify_languages(odd, net, ["doc_id", "predicted"]).collect()
    assert [r.lang_pred for r in rows][:4] == ["und"] * 4
    assert rows[4].lang_pred == "en" and rows[5].lang_pred == "und" and rows[6].lang_pred != "und"
    assert all(r.score == 0 for r in rows if r.lang_pred == "und")
    assert identify_languages(odd.limit(0), net, ["doc_id"]).count() == 0
    for r in language_spans(odd, net, ["doc_id"]).collect():
        assert r.starts == [0, *r.ends][: len(r.starts)]


def test_learning_needs_labels(spark, labelled):
    docs, labels = labelled
    with pytest.raises(ValueError):
        fit_quality(docs, labels.where("quality = 1"))
    with pytest.raises(ValueError):
        fit_toxicity(docs, labels.limit(0))
    with pytest.raises(ValueError):
        train_languages(docs.withColumn("lang", F.lit(None).cast("string")))


def test_pair_term_equals_the_sum_over_pairs():
    pick = np.random.default_rng(1)
    model = FactorisationMachine(0.3, pick.normal(size=50), pick.normal(size=(50, 4)))
    index = np.array([3, 7, 9, 20, 1, 2])
    value = pick.normal(size=6)
    of = np.array([0, 0, 0, 0, 1, 1])
    wanted = []
    for t in (0, 1):
        at = np.flatnonzero(of == t)
        y = 0.3 + sum(model.weights[index[i]] * value[i] for i in at)
        for a in at:
            for b in at[at > a]:
                y += model.factors[index[a]] @ model.factors[index[b]] * value[a] * value[b]
        wanted.append(y)
    assert model.margin(index, value, of, 2) == pytest.approx(wanted)


def test_gradients_match_differences():
    """Backpropagation through time against finite differences of the loss."""
    pick = np.random.default_rng(2)
    windows = pick.integers(97, 123, (6, SPAN)).astype(np.uint8)
    sizes = np.array([SPAN, SPAN, 10, 1, 30, SPAN])
    labels = np.array([0, 1, 0, 1, 0, 1])
    net = ByteNetwork.train(windows, sizes, labels, ["a", "b"], steps=1)
    x = windows.T
    inside = (np.arange(SPAN)[:, None] < sizes).astype(np.float32)[:, None]

    def loss():
        p = net.probabilities(x, inside)[0]
        chosen = p[:, labels, np.arange(6)]
        return float(-(np.log(chosen) * inside[:, 0]).sum() / inside.sum())

    keep = ({}, {})
    wrong, _ = net.probabilities(x, inside, keep)
    wrong[:, labels, np.arange(6)] -= 1
    wrong *= inside / inside.sum()
    slope = np.matmul(net.read_out.T, wrong)
    units = net.ahead.recur.shape[1]
    order = list(range(SPAN))
    found = net.ahead.gradients(x, inside, order, keep[0], slope[:, :units])
    found += net.behind.gradients(x, inside, order[::-1], keep[1], slope[:, units:])
    for p, g in zip(net.parameters()[:6], found):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        before = p[at]
        p[at] = before + 1e-2
        up = loss()
        p[at] = before - 1e-2
        down = loss()
        p[at] = before
        assert (up - down) / 2e-2 == pytest.approx(float(g[at]), rel=0.05, abs=2e-4)


def test_windows_cover_every_byte(spark, labelled):
    net = train_languages(labelled[0])
    import pyarrow as pa

    texts = Texts.of(pa.array(["", "a", "x" * SPAN, "y" * (SPAN + 1), "z" * 1000]))
    seen = np.zeros(len(texts.data), int)

    def visit(of, begins, inside, p):
        at = begins + np.arange(p.shape[0])[:, None]
        ok = np.ones_like(at, bool) if inside is None else inside[:, 0] > 0
        np.add.at(seen, at[ok], 1)
        assert np.allclose(p.sum(1), 1, atol=1e-4)

    net.label(texts, visit)
    assert (seen == 1).all()
    assert net.pooled(texts)[1:].sum(1) == pytest.approx(1, abs=1e-4)


@pytest.mark.parametrize(
    "written, plain",
    [("cl0wn", "clown"), ("stuuuupid", "stupid"), ("i.d.i.o.t", "idiot"), ("m0r0n", "moron"),
     ("tr@sh", "trash"), ("l_o_s_e_r", "loser"), ("IDIOT!!", "idiot"), ("plain,", "plain"),
     ("2023", "2023"), ("", ""), ("...", "")],
)
def test_restored_words(spark, labelled, written, plain):
    model = _toxic(labelled)
    assert restore(written, model.characters) == plain


@pytest.mark.parametrize(
    "written, plain",
    [("1diot", "idiot"), ("!diot", "idiot"), ("|diot", "idiot"), ("1d10t", "idiot"), ("!d!0t", "idiot"),
     ("7rash", "trash"), ("+rash", "trash"), ("$tupid", "stupid"), ("1oser", "loser"),
     ("i...d...i...o...t", "idiot"), ("\u0456diot", "idiot"), ("id\u200biot", "idiot")],
)
def test_first_letters_and_hidden_ones(spark, labelled, written, plain):
    assert restore(written, _toxic(labelled).characters) == plain


def test_marks_before_plain_words_are_no_letters(spark):
    known = CharacterModel({"  r": 5, " ra": 5, "rap": 5, "ap ": 5, "  c": 5, " cr": 5, "cra": 5},
                           words=frozenset({"rap", "crap"}))
    assert restore("(rap)", known) == "rap"


def test_words_set_apart(spark, labelled):
    model = _toxic(labelled)
    got = restored_text("you are an i d i o t and a c-l-o-w-n here", model.characters)
    assert "idiot" in got and "clown" in got


@pytest.mark.parametrize(
    "written",
    ['"i d i o t"', "(i d i o t)", "«i d i o t», he", "i   d   i   o   t.", "i\nd\ni\no\nt", "i. d. i. o. t!"],
)
def test_words_set_apart_in_punctuation_and_blanks(spark, labelled, written):
    assert "idiot" in restored_text(f"you are {written}", _toxic(labelled).characters)


@pytest.mark.parametrize(
    "written, plain", [("mooron", "moron"), ("iddiot", "idiot"), ("sttupid", "stupid")]
)
def test_letters_doubled_as_disguise(spark, labelled, written, plain):
    assert restore(written, _toxic(labelled).characters) == plain


def test_viterbi_finds_the_cheapest_reading(spark, labelled):
    from itertools import product

    model = _toxic(labelled).characters
    for word in ["1d10t", "$cum", "st00p1d", "baaad"]:
        lattice = lattice_of(word, False)

        def cost(reading):
            total, end = sum(x for _, x in reading), "  "
            for c in "".join(t for t, _ in reading) + " ":
                total += model.cost(end, c)
                end = end[1] + c
            return total

        best = min(product(*lattice), key=cost)
        assert model.likeliest(lattice) == "".join(t for t, _ in best).strip()


_models = {}


def _toxic(labelled):
    if "toxic" not in _models:
        _models["toxic"] = fit_toxicity(*labelled)
    return _models["toxic"]


def test_toxicity_learns_from_all_labelled_rows(spark):
    """A word of the toxic rows whose keys have the highest hashes is learned too."""
    ids = spark.range(2400).select(F.col("id").alias("doc_id"), F.xxhash64("id").alias("h"))
    ids = ids.withColumn("toxic", (F.col("doc_id") < 1600).cast("int"))
    last = sorted((r.h, r.doc_id) for r in ids.where("toxic = 1").collect())[-12:]
    word = F.when(F.col("doc_id").isin([i for _, i in last]), "zibbert").when(F.col("toxic") == 1, "grum")
    rows = ids.withColumn("text", F.concat_ws(" ", F.lit("plain words"), word, F.hex("doc_id"))).cache()
    model = fit_toxicity(rows.select("doc_id", "text"), rows.select("doc_id", "toxic"), candidates=2)
    assert {"zibbert ", "grum "} <= set(model.number) and "plain " not in model.number
    odd = spark.createDataFrame([(1, "a zibbert"), (2, "a word")], "doc_id long, text string")
    scores = {r.doc_id: r.score for r in score_toxicity(odd, model, ["doc_id"]).collect()}
    assert scores[1] > 0.5 and scores[1] > scores[2]


def _noted(monkeypatch):
    """Plans of the frames that toxicity stages, by name."""
    from ringcast.llm import toxicity

    plans, real = {}, toxicity.stage

    def noted(df, name):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        return real(df, name)

    monkeypatch.setattr(toxicity, "stage", noted)
    return plans


def test_texts_of_other_rows_are_not_shuffled(spark, monkeypatch):
    """Texts that teach nothing are ruled out by a filter before the join."""
    plans = _noted(monkeypatch)
    ids = spark.range(200).withColumn("toxic", (F.col("id") % 2).cast("int"))
    ids = ids.withColumn("text", F.concat(F.lit("word "), F.when(F.col("toxic") == 1, "grum"))).limit(199)
    some = ids.select(F.col("id").alias("doc_id"), "text")
    fit_toxicity(some, ids.where("id < 40").select(F.col("id").alias("doc_id"), "toxic"))
    below = plans["toxicity-learning"].split("Join Inner")[1]
    assert "bit_get" in below and "text" in below


def test_learning_rows_are_distinct_texts_of_one_label(spark, monkeypatch):
    """Null and empty texts are two; rows alike in key and text are one."""
    from ringcast.llm import toxicity

    rows = [(1, "a"), (1, "a"), (2, "a"), (1, "b"), (3, "c"), (4, "c"), (5, None), (6, ""), (7, "d"), (None, "e")]
    labels = [(1, 1), (2, 1), (3, 0), (4, 1), (5, 0), (6, 1), (7, 0), (7, 1), (None, 1)]
    seen, real = {}, toxicity.stage

    def noted(df, name):
        seen[name] = staged = real(df, name)
        return staged

    monkeypatch.setattr(toxicity, "stage", noted)
    fit_toxicity(spark.createDataFrame(rows, "doc_id long, text string"),
                 spark.createDataFrame(labels, "doc_id long, toxic int"))
    got = [(r.doc_id, r.text, r.label) for r in seen["toxicity-learning"].collect()]
    assert sorted(got, key=str) == [(1, "a", 1), (1, "b", 1), (5, None, 0), (6, "", 1)]


def test_features_are_those_of_restored_words(monkeypatch):
    """Whatever is skipped or kept; no reading is looked for if none can have a feature."""
    from ringcast.llm import toxicity
    from ringcast.llm.toxicity import _apart, _Known, _maybe_apart, _words, word_features

    grams = [f"  {w} "[i : i + 3] for w in ("idiot", "trash", "off", "ball") for i in range(len(w) + 1)]
    model = CharacterModel(dict.fromkeys(grams, 5), words=frozenset({"idiot", "trash", "off"}))
    number = {f: i for i, f in enumerate(["idi", "idiot ", "tra", "off ", "of ", "ball", "l "])}
    pick = np.random.default_rng(3)
    signs = list("idotrashfbl10!@|+$.-_* \n\xa0\x1c​іé'(\",")
    texts = ["".join(pick.choice(signs, n)) for n in pick.integers(0, 40, 3000)]
    texts += ["1diot", "i d i o t", "iddiot!", "off", "!(off", "_" * 5000, " " * 5000]
    known = _Known(model, number)
    for text in texts:
        whole = [restore(w, model) for w in _words.findall(text)]
        whole += [model.likeliest(lattice_of(m[0].lower(), True)) for m in _apart.finditer(text)]
        wanted = {number[f] for w in whole for f in word_features(w) if f in number}
        assert known.in_text(text) == wanted
        assert _maybe_apart.search(text) or not _apart.search(text)
    monkeypatch.setattr(toxicity, "_reading", None)
    assert _Known(model, number).in_text("zoo b00k sell!") == set()
