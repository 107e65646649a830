from pathlib import Path

import pytest

from ringcast.llm import licences
from ringcast.llm.licences import SHARED, TEMPLATES, scan_licences, train_licences

PLAIN = "This is an ordinary line about the river and the law of the town."


@pytest.fixture(scope="module")
def model(spark, sf):
    return train_licences(spark.read.parquet(f"{sf}/documents.parquet"))


def scan(spark, model, rows, schema="doc_id long, text string"):
    docs = spark.createDataFrame(rows, schema)
    return sorted(
        ((r.doc_id, r.paragraph, r.licence) for r in scan_licences(docs, model).collect()), key=str
    )


def test_every_template_in_any_case_and_place(spark, model):
    texts = [(f, t) for f, ts in TEMPLATES.items() for t in ts]
    rows = [(i, f"{PLAIN}\n{t.upper()}\n{PLAIN}") for i, (_, t) in enumerate(texts)]
    wanted = sorted(((i, 1, f) for i, (f, _) in enumerate(texts)), key=str)
    assert scan(spark, model, rows) == wanted


@pytest.mark.parametrize(
    "line",
    [
        PLAIN,
        "He got a licence, version 3 of it, under the general public school law.",
        "Released under the moon, the license of the poet is a common joke.",
        "licensed under the",
        "The MIT campus is open to the public.",
        "",
    ],
)
def test_other_lines_are_unknown(spark, model, line):
    assert scan(spark, model, [(1, line)]) == []


def test_changed_words_are_still_found(spark, model):
    line = "The data of this site are released under the MIT license, see the file."
    assert scan(spark, model, [(1, line)]) == [(1, 0, "mit")]


def test_nulls_repeats_and_clashing_names(spark, model):
    mit, gpl = TEMPLATES["mit"][0], TEMPLATES["gpl-3.0"][0]
    long = "\n".join([PLAIN] * 3000 + [gpl])
    rows = [(None, mit, 1, "r"), (2, None, 1, "r"), (3, f"{mit}\n{gpl}\n{mit}", 1, "r")] * 2
    got = scan(
        spark, model, [*rows, (4, long, 2, None)],
        "doc_id long, text string, paragraph int, run string",
    )
    assert got == [(3, 0, "mit"), (3, 1, "gpl-3.0"), (3, 2, "mit"),
                   (4, 3000, "gpl-3.0"), (None, 0, "mit")]
    assert scan(spark, model, []) == []


def test_whole_table_against_the_planted_lines(spark, model, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    lines = {
        (r.doc_id, i)
        for r in docs.collect()
        for i, x in enumerate((r.text or "").split("\n"))
        if any(x.strip() == t for ts in TEMPLATES.values() for t in ts)
    }
    got = {(r.doc_id, r.paragraph) for r in scan_licences(docs, model).collect()}
    assert got == lines and lines


BSD = [t for f, t in SHARED if f == ("bsd-2-clause", "bsd-3-clause")]
THIRD = TEMPLATES["bsd-3-clause"][0]


def test_shared_paragraphs_by_the_rest_of_the_document(spark, model):
    rows = [(1, "\n".join(BSD)), (2, "\n".join([*BSD[:3], THIRD, BSD[3]])), (3, BSD[0])]
    wanted = [(1, i, "bsd-2-clause") for i in range(4)]
    wanted += [(2, i, "bsd-3-clause") for i in range(5)] + [(3, 0, "unknown")]
    assert scan(spark, model, rows) == wanted


def test_shared_disclaimer_beside_a_notice(spark, model):
    disclaimer = next(t for f, t in SHARED if f == ("mit", "unlicense"))
    rows = [(i, f"{TEMPLATES[f][0]}\n{disclaimer}") for i, f in enumerate(["mit", "unlicense"])]
    wanted = [(i, j, f) for i, f in enumerate(["mit", "unlicense"]) for j in (0, 1)]
    assert scan(spark, model, rows) == wanted


def test_wrapped_bodies(spark, model):
    bodies = sorted(Path(licences.__file__).with_name("licence_texts").glob("*.txt"))
    rows = [(i, p.read_text()) for i, p in enumerate(bodies)]
    got = scan(spark, model, rows)
    for i, path in enumerate(bodies):
        lines = [x for x in rows[i][1].split("\n") if len(x.split()) >= 10]
        families = [f for d, _, f in got if d == i]
        assert families.count(path.stem) >= 0.8 * len(lines), path.stem
        assert families.count(path.stem) >= 0.95 * len(families), path.stem


def test_unlisted_licences_are_reported_as_unknown(spark, model):
    rows = [
        (1, "This font is released under the Quiet River Font License."),
        (2, "SPDX-License-Identifier: Zlib"),
        (3, PLAIN),
    ]
    assert scan(spark, model, rows) == [(1, 0, "unknown"), (2, 0, "unknown")]
