"""Licence scans: a trained paragraph classifier, confirmed by comparison with templates.

A paragraph is a line.  Its features are its distinct runs of two and three words (lower
case letters, digits and inner points or hyphens) that some template holds.  A multinomial
logistic regression tells licence families and an unknown class apart; it is fitted on
pieces of the notices, on pieces that several families share and ordinary sentences
(both unknown), and on at most ``BACKGROUND`` lines of the corpus that are unlike every
notice.  On a third of the pieces kept aside, the unknown class's margin is shifted until
its mean probability is the share that is really unknown.

A family fits a paragraph if the paragraph holds ``CONFIRMED`` of the runs of one of its
notices or shared paragraphs, or if that share of the paragraph's runs of three words,
``LEAST`` at least, is of the family's texts (so also each line of a wrapped licence
body); for the family that the classifier predicts, that share of runs of its notices is
enough, three at least.  Where several families fit alike, the document decides: the one
that most other paragraphs fit alone, then the one whose paragraphs (``SHARED``, ``ALONE``)
it holds all or nearly all.  If that leaves several, or if a line speaks of a licence it
is under and no family fits, the paragraph is reported as unknown.

Scoring is done with DataFrame functions alone.  The result has one row per such
paragraph, with the classifier's probability of the reported class and the best likeness
to it (for unknown, to any family); a document without one has no row, and so have null
and empty texts.  Rows alike in key and text are reported once; null keys are kept.  An
empty table gives an empty result.

Bodies in ``licence_texts`` are whole.  Of AGPL-3.0 and the CC NC and ND licences, only
what they share with those bodies and the paragraphs below are known; of EPL-2.0 and
EPL-1.0, the notices and paragraphs below.
"""

from __future__ import annotations

import math
import re
from functools import cache, reduce
from pathlib import Path

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

UNKNOWN = "unknown"
CONFIRMED = 0.6
LEAST = 6
BACKGROUND = 500
REGULARISATION, TURNS = 1e-4, 60

#: Fixed texts: the usual notices and paragraphs that each family has alone.
TEMPLATES = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this "
        "file except in compliance with the License.",
        "Unless required by applicable law or agreed to in writing, software distributed "
        "under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied.",
        "Apache License Version 2.0, January 2004",
    ],
    "bsd-3-clause": [
        "Neither the name of the copyright holder nor the names of its contributors may be "
        "used to endorse or promote products derived from this software without specific "
        "prior written permission.",
        "Released under the BSD 3-Clause License.",
    ],
    "cc-by-4.0": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "cc-by-nc-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 "
        "International License.",
    ],
    "cc-by-sa-4.0": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 "
        "International License.",
    ],
    "cc0-1.0": [
        "To the extent possible under law, the author has waived all copyright and related "
        "or neighboring rights to this work.",
        "Released under CC0 1.0 Universal.",
    ],
    "gpl-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the "
        "terms of the GNU General Public License as published by the Free Software "
        "Foundation; either version 2 of the License, or (at your option) any later version.",
    ],
    "gpl-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the "
        "terms of the GNU General Public License as published by the Free Software "
        "Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "lgpl-3.0": [
        "This library is free software; you can redistribute it and/or modify it under the "
        "terms of the GNU Lesser General Public License, version 3.",
        "Licensed under the GNU Lesser General Public License, version 3.",
    ],
    "mit": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the Software), to deal in the Software "
        "without restriction.",
        "The above copyright notice and this permission notice shall be included in all "
        "copies or substantial portions of the Software.",
    ],
    "mpl-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
    ],
    "agpl-3.0": [
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the "
        "terms of the GNU Affero General Public License as published by the Free Software "
        "Foundation, either version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU Affero General Public License along with "
        "this program.",
        "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007",
        "Notwithstanding any other provision of this License, if you modify the Program, your "
        "modified version must prominently offer all users interacting with it remotely "
        "through a computer network (if your version supports such interaction) an "
        "opportunity to receive the Corresponding Source of your version by providing access "
        "to the Corresponding Source from a network server at no charge, through some "
        "standard or customary means of facilitating copying of software.",
    ],
    "bsd-2-clause": [
        "Released under the BSD 2-Clause License.",
    ],
    "cc-by-nc-nd-4.0": [
        "Licensed under CC BY-NC-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives "
        "4.0 International License.",
        "Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International Public License",
    ],
    "cc-by-nc-sa-4.0": [
        "Licensed under CC BY-NC-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike "
        "4.0 International License.",
        "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International Public License",
    ],
    "cc-by-nd-4.0": [
        "Licensed under CC BY-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 "
        "International License.",
        "Creative Commons Attribution-NoDerivatives 4.0 International Public License",
    ],
    "epl-1.0": [
        "This program and the accompanying materials are made available under the terms of "
        "the Eclipse Public License v1.0 which accompanies this distribution.",
        "Licensed under the Eclipse Public License, version 1.0.",
        "Eclipse Public License - v 1.0",
    ],
    "epl-2.0": [
        "This program and the accompanying materials are made available under the terms of "
        "the Eclipse Public License 2.0 which is available at "
        "https://www.eclipse.org/legal/epl-2.0/",
        "Licensed under the Eclipse Public License, version 2.0.",
        "Eclipse Public License - v 2.0",
    ],
    "isc": [
        "Released under the ISC License.",
        "Licensed under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with "
        "or without fee is hereby granted, provided that the above copyright notice and this "
        "permission notice appear in all copies.",
        "THE SOFTWARE IS PROVIDED AS IS AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD "
        "TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN "
        "NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR "
        "CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR "
        "PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, "
        "ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ],
    "lgpl-2.1": [
        "This library is free software; you can redistribute it and/or modify it under the "
        "terms of the GNU Lesser General Public License as published by the Free Software "
        "Foundation; either version 2.1 of the License, or (at your option) any later version.",
        "Licensed under the GNU Lesser General Public License, version 2.1.",
    ],
    "unlicense": [
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this "
        "software, either in source code form or as a compiled binary, for any purpose, "
        "commercial or non-commercial, and by any means.",
        "In jurisdictions that recognize copyright laws, the author or authors of this "
        "software dedicate any and all copyright interest in the software to the public "
        "domain. We make this dedication for the benefit of the public at large and to the "
        "detriment of our heirs and successors. We intend this dedication to be an overt act "
        "of relinquishment in perpetuity of all present and future rights to this software "
        "under copyright law.",
    ],
}
_BSD = ("bsd-2-clause", "bsd-3-clause")
_CC = ("cc-by-4.0", "cc-by-nc-4.0", "cc-by-nc-nd-4.0", "cc-by-nc-sa-4.0", "cc-by-nd-4.0",
       "cc-by-sa-4.0")
_NC = tuple(f for f in _CC if "-nc" in f)
_ND = tuple(f for f in _CC if "-nd" in f)
#: Paragraphs that several families have.
SHARED = [
    (_BSD, "Redistribution and use in source and binary forms, with or without modification, "
     "are permitted provided that the following conditions are met:"),
    (_BSD, "Redistributions of source code must retain the above copyright notice, this list "
     "of conditions and the following disclaimer."),
    (_BSD, "Redistributions in binary form must reproduce the above copyright notice, this "
     "list of conditions and the following disclaimer in the documentation and/or other "
     "materials provided with the distribution."),
    (_BSD, "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY "
     "EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF "
     "MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL "
     "THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
     "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT "
     "OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS "
     "INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, "
     "STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF "
     "THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."),
    (("mit", "unlicense"), "THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, "
     "EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, "
     "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."),
    (("mit",), "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, "
     "DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING "
     "FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE "
     "SOFTWARE."),
    (("unlicense",), "IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
     "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR "
     "IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    (("mit",), "to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
     "copies of the Software, and to permit persons to whom the Software is furnished to do "
     "so, subject to the following conditions:"),
    (("epl-1.0", "epl-2.0"), "THE ACCOMPANYING PROGRAM IS PROVIDED UNDER THE TERMS OF THIS "
     "ECLIPSE PUBLIC LICENSE (AGREEMENT). ANY USE, REPRODUCTION OR DISTRIBUTION OF THE PROGRAM "
     "CONSTITUTES RECIPIENT'S ACCEPTANCE OF THIS AGREEMENT."),
    (("agpl-3.0", "gpl-2.0", "gpl-3.0"), "This program is distributed in the hope that it will "
     "be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
     "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."),
    (("gpl-2.0", "gpl-3.0"), "You should have received a copy of the GNU General Public License "
     "along with this program."),
    (("lgpl-2.1", "lgpl-3.0"), "You should have received a copy of the GNU Lesser General "
     "Public License along with this library."),
    (_NC, "NonCommercial means not primarily intended for or directed towards commercial "
     "advantage or monetary compensation."),
    (_ND, "For the avoidance of doubt, You do not have permission under this Public License to "
     "Share Adapted Material."),
]
#: Paragraphs whose absence tells families with the same SHARED ones apart.
ALONE = {"bsd-3-clause": [TEMPLATES["bsd-3-clause"][0]]}
#: A line that says under which licence something is, or grants as licences do.
CUE = (
    r"(?i)\b(?:licen[cs]ed|released|distributed|published|made available|provided)\s+under\s+"
    r"(?:[\w.+\-'\x22]+\s+){0,8}?licen[cs]e\b|\bSPDX-License-Identifier:\s*\S"
    r"|\bpermission is (?:hereby )?granted,? (?:to|free of charge)\b"
    r"|\bpermission to use, copy,? (?:and )?modify\b"
    r"|\bas[ -]is\b.{0,3},? (?:and )?without (?:any )?(?:express|implied|warrant)"
)
_MARK = "(cue)"  # no run of words: those have no brackets
#: Sentences that use the templates' words otherwise.
ORDINARY = [
    "He lost his driving licence and was fined under the new law.",
    "The committee released the report under pressure from the public.",
    "A general public meeting is held in the free library of the town.",
    "Version 3 of the game will be out in January.",
    "The work is free of charge to any person in the town.",
    "Students of MIT built a free software foundation in the lab.",
    "The Apache helicopter is distributed in two versions.",
    "She may not use this file in the office.",
    "The name of the author is on the copy of the book.",
    "Terms of the public school are published by the city.",
    "You may be licensed under the state board as a nurse.",
    "Creative people share common rights to their work.",
    "Without restriction, the source of the river is open to all.",
    "This permission was granted by the owner of the house.",
    "The conditions are met and the contributors may be paid.",
    "The law of any kind is either express or implied in writing.",
]

_word = re.compile(r"[a-z0-9]+(?:[.\-][a-z0-9]+)*")


def _python_words(text: str) -> list[str]:
    return _word.findall(text.lower())


def _python_runs(words: list[str]) -> set[str]:
    return {" ".join(words[i : i + n]) for n in (2, 3) for i in range(len(words) - n + 1)}


def runs_of(paragraph: Column) -> Column:
    """Distinct runs of two and three words, as 64-bit hashes of the joined words.

    A struct of ``runs``, both, and ``threes``, the number of those of three words.
    """
    words = F.regexp_extract_all(F.lower(paragraph), F.lit(_word.pattern), F.lit(0))

    def joined(w, n):
        def run(i):
            return F.xxhash64(F.concat_ws(" ", *[F.get(w, i + j) for j in range(n)]))

        many = F.size(w) - n
        return F.when(
            many >= 0, F.transform(F.sequence(F.lit(0), F.greatest(many, F.lit(0))), run)
        ).otherwise(F.array().cast("array<bigint>"))

    pair = F.transform(
        F.array(words),
        lambda w: F.struct(
            F.array_distinct(joined(w, 2)).alias("two"),
            F.array_distinct(joined(w, 3)).alias("three"),
        ),
    )
    both = F.transform(
        pair,
        lambda p: F.struct(
            F.array_distinct(F.concat(p["two"], p["three"])).alias("runs"),
            F.size(p["three"]).alias("threes"),
        ),
    )
    return F.element_at(both, 1)


def _pieces() -> tuple[list[tuple[list[str], str]], list[tuple[list[str], str]]]:
    """Learning and held pieces: words and family."""
    made: list[tuple[list[str], str]] = []
    where: dict[str, set[str]] = {}
    for family, texts in TEMPLATES.items():
        for text in texts:
            words = _python_words(text)
            for share in (0.6, 0.75, 0.9, 1.0):
                size = max(3, math.ceil(share * len(words)))
                for start in {0, (len(words) - size) // 2, len(words) - size}:
                    if start >= 0:
                        made.append((words[start : start + size], family))
            for run in _python_runs(words):
                where.setdefault(run, set()).add(family)
    for families, text in SHARED:
        words = _python_words(text)
        made.append((words, UNKNOWN if len(families) > 1 else families[0]))
        for run in _python_runs(words):
            where.setdefault(run, set()).update(families)
    made += [(_python_words(t), UNKNOWN) for t in ORDINARY]
    made += [(run.split(), UNKNOWN) for run, of in sorted(where.items()) if len(of) > 1]
    # a piece of one family that another shares word for word teaches nothing certain
    owners: dict[str, set[str]] = {}
    for words, family in made:
        owners.setdefault(" ".join(words), set()).add(family)
    clear = [(w, f) for w, f in made if len(owners[" ".join(w)]) == 1]
    return [p for i, p in enumerate(clear) if i % 3], clear[::3]


def _runs_in(text: str) -> frozenset[str]:
    return frozenset(_python_runs(_python_words(text)))


@cache
def _notices() -> list[tuple[tuple[str, ...], frozenset[str]]]:
    """Families and runs of every notice and shared paragraph, in fixed order."""
    alone = [((f,), t) for f in sorted(TEMPLATES) for t in TEMPLATES[f]]
    return [(f, _runs_in(t)) for f, t in [*alone, *SHARED]]


@cache
def _bodies() -> dict[str, int]:
    """Runs of three words of all texts, with the families that hold them as bits."""
    bit = {f: 1 << c for c, f in enumerate(sorted(TEMPLATES))}
    out: dict[str, int] = {}

    def threes(text):
        return {r for r in _python_runs(_python_words(text)) if r.count(" ") == 2}

    def add(runs, families):
        for run in runs:
            out[run] = out.get(run, 0) | sum(bit[f] for f in families)

    for families, runs in _notices():
        add([r for r in runs if r.count(" ") == 2], families)
    texts = {p.stem: p.read_text() for p in Path(__file__).with_name("licence_texts").glob("*.txt")}
    held = {f: threes(t) for f, t in texts.items()}
    for family, runs in held.items():
        add(runs, [family])
    # the licences of one author have most of their text in common
    add(held["cc-by-4.0"] & held["cc-by-sa-4.0"], _CC)
    terms = texts["gpl-3.0"].partition("TERMS AND CONDITIONS")[2].partition("END OF TERMS")[0]
    before, _, rest = terms.partition("13. Use with the GNU Affero")
    common = threes(before) | threes(rest.partition("14. Revised")[2])
    add([r for r in common if "gnu general" not in r], ["agpl-3.0"])
    return out


def _background(docs: DataFrame, text: str) -> list[list[str]]:
    """At most BACKGROUND lines, by hash, that share few runs with any template."""
    lines = docs.select(F.explode(F.split(F.col(f"`{text}`"), "\n")).alias("line"))
    lines = lines.where(F.length("line").between(20, 400))
    lines = lines.orderBy(F.xxhash64("line"), "line").limit(BACKGROUND)
    known = set().union(*(_python_runs(_python_words(t)) for ts in TEMPLATES.values() for t in ts))
    words = [_python_words(r.line) for r in lines.collect()]
    return [w for w in words if len(_python_runs(w) & known) < 3]


def train_licences(docs: DataFrame, text: str = "text") -> DataFrame:
    """A table of fixed size: run, its weight for each class, and the templates with it.

    The row with a null run holds the intercepts.  Classes are the families in order of
    name, then unknown.
    """
    spark = docs.sparkSession
    classes = [*sorted(TEMPLATES), UNKNOWN]
    templates = _notices()
    vocabulary = sorted(set().union(*(runs for _, runs in templates)))
    learn, held = _pieces()
    learn += [(w, UNKNOWN) for w in _background(docs, text)]

    def frame(pieces):
        rows = [(sorted(_python_runs(w)), float(classes.index(f))) for w, f in pieces]
        return spark.createDataFrame(rows, "runs array<string>, label double").coalesce(1)

    vectors = CountVectorizerModel.from_vocabulary(vocabulary, "runs", "features").setBinary(True)
    fitted = LogisticRegression(
        family="multinomial", regParam=REGULARISATION, maxIter=TURNS, standardization=False
    ).fit(vectors.transform(frame(learn)))
    weights, intercepts = fitted.coefficientMatrix.toArray(), list(fitted.interceptVector)

    number = {run: i for i, run in enumerate(vocabulary)}
    margins = []
    for words, _ in held:
        at = [number[r] for r in _python_runs(words) if r in number]
        margins.append([b + float(weights[c, at].sum()) for c, b in enumerate(intercepts)])
    share = sum(f == UNKNOWN for _, f in held) / len(held)

    def mean_unknown(shift):
        total = 0.0
        for m in margins:
            shifted = [*m[:-1], m[-1] + shift]
            top = max(shifted)
            parts = [math.exp(x - top) for x in shifted]
            total += parts[-1] / sum(parts)
        return total / len(margins)

    low, high = -20.0, 20.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if mean_unknown(middle) < share else (low, middle)
    intercepts[-1] += (low + high) / 2

    rows = [(None, [float(b) for b in intercepts], [], 0)]
    bodies = _bodies()
    for run, i in number.items():
        holds = [t for t, (_, runs) in enumerate(templates) if run in runs]
        rows.append((run, [float(x) for x in weights[:, i]], holds, bodies.get(run, 0)))
    rows += [(run, None, [], held_by) for run, held_by in bodies.items() if run not in number]
    rows.append((_MARK, None, [], 0))
    return spark.createDataFrame(
        rows, "run string, weights array<double>, templates array<int>, bodies bigint"
    )


def let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once however often ``body`` names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def scan_licences(
    docs: DataFrame, model: DataFrame, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Reported paragraphs: key, paragraph (from 0), licence, probability, similarity."""
    classes = [*sorted(TEMPLATES), UNKNOWN]
    families = range(len(classes) - 1)
    notices = _notices()
    sizes = [len(runs) for _, runs in notices]
    of = [[t for t, (fs, _) in enumerate(notices) if classes[c] in fs] for c in families]
    intercepts = model.where("run is null").first().weights

    known = model.where("run is not null").select(
        F.xxhash64("run").alias("run"), "weights", "templates", "bodies"
    )
    mark = F.xxhash64(F.lit(_MARK))
    texts = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    paragraphs = texts.select(
        "key",
        F.xxhash64("text").alias("same"),
        F.posexplode(F.split("text", "\n")).alias("paragraph", "line"),
    )
    cue = F.when(F.col("line").rlike(CUE), F.array(mark)).otherwise(
        F.array().cast("array<bigint>")
    )
    runs = paragraphs.select("*", runs_of(F.col("line")).alias("runs"), cue.alias("cue")).select(
        "key", "same", "paragraph", F.size("runs.runs").alias("n"), "runs.threes",
        F.explode(F.concat("runs.runs", "cue")).alias("run"),
    )
    place = ["key", "same", "paragraph", "n", "threes"]
    # the model's size is fixed by the texts of the families
    hits = runs.join(F.broadcast(known.select("run")), "run")
    hits = hits.groupBy(*place).agg(F.collect_set("run").alias("runs"))
    # what holds fewer runs than any way to fit asks for is left out early
    many, cued = F.size("runs"), F.array_contains("runs", mark)
    enough = (many >= 3) & (many >= CONFIRMED * F.least(F.lit(min(sizes)), "n"))
    enough |= many >= CONFIRMED * F.col("threes")
    hits = hits.where(cued | ((many >= 3) & enough))
    hits = hits.select(*place, cued.alias("cued"), F.explode("runs").alias("run"))
    hits = hits.join(F.broadcast(known), "run")
    place = [*place, "cued"]
    held = F.collect_list(F.struct("weights", "templates", "bodies")).alias("held")
    scored = hits.groupBy(*place).agg(held)

    # how well each family fits each paragraph
    def numbers(values):
        return F.array(*map(F.lit, values))

    every, ofs = numbers(families), F.array(*map(numbers, of))
    weighed = F.filter("held", lambda x: x["weights"].isNotNull())
    margins = F.aggregate(
        weighed,
        numbers(float(b) for b in intercepts),
        lambda m, x: F.zip_with(m, x["weights"], lambda u, v: u + v),
    )

    def cover(held):
        """The share of each notice's runs that the paragraph holds."""
        return let(
            F.flatten(F.transform(held, lambda x: x["templates"])),
            lambda all_of: F.transform(
                numbers(range(len(sizes))),
                lambda t: F.size(F.filter(all_of, lambda x: x == t)) / F.get(numbers(sizes), t),
            ),
        )

    def fit_of(covered, margins):
        """For each family: how well it fits, and how much of a notice of it is there."""
        one = F.transform(
            ofs, lambda ts: F.array_max(F.transform(ts, lambda t: F.get(covered, t)))
        )
        found = F.transform(
            every, lambda c: F.size(F.filter("held", lambda x: F.getbit(x["bodies"], c) == 1))
        )
        lines = F.transform(
            found, lambda b: F.when(b >= LEAST, b / F.col("threes")).otherwise(0.0)
        )
        at = F.array_position(margins, F.array_max(margins)).cast("int") - 1

        def inside(at):
            ts = F.get(ofs, at)
            own = F.size(F.filter("held", lambda x: F.arrays_overlap(x["templates"], ts)))
            share = let(own, lambda n: F.when(n >= 3, n / F.col("n")).otherwise(0.0))
            each = F.when(at < len(of), share).otherwise(0.0)
            return let(each, lambda s: F.transform(
                every, lambda c: F.when(c == at, s).otherwise(0.0)
            ))

        return F.zip_with(
            one,
            F.zip_with(lines, let(at, inside), lambda a, b: F.greatest(a, b)),
            lambda o, rest: F.struct(
                F.greatest(o, rest).alias("fits"),
                F.when(o >= CONFIRMED, o).otherwise(0.0).alias("notice"),
            ),
        )

    # the best: by likeness, then whole notices before runs found here and there in a body
    def best_of(pairs):
        return let(F.array_max(pairs), lambda most: F.when(
            most["fits"] >= CONFIRMED,
            F.filter(every, lambda c: F.get(pairs, c) == most),
        ).otherwise(F.array().cast("array<int>")))

    def judged(x):
        pairs = fit_of(x["covered"], x["margins"])
        return let(pairs, lambda ps: F.struct(
            x["covered"].alias("covered"), x["margins"].alias("margins"),
            F.transform(ps, lambda p: p["fits"]).alias("fits"), best_of(ps).alias("fit"),
        ))

    both = F.struct(cover(F.col("held")).alias("covered"), margins.alias("margins"))
    scored = scored.select(*place, F.explode(F.transform(F.array(both), judged)).alias("x"))
    scored = scored.select(*place, "x.*").where("cued or size(fit) > 0")

    # of families that fit alike, the document's other paragraphs choose
    document = Window.partitionBy("key", "same")
    single = F.when(F.size("fit") == 1, F.get("fit", F.lit(0)))
    # families whose whole text is SHARED and ALONE paragraphs
    texts_of = {f: [] for f in classes[:-1]}
    for t, (fs, runs_) in enumerate(notices):
        if fs == _BSD or (fs[0] in ALONE and runs_ in map(_runs_in, ALONE[fs[0]])):
            for f in fs:
                texts_of[f].append(t)
    parts = sorted({t for ts in texts_of.values() for t in ts})
    totals = [F.sum(F.get("covered", F.lit(t))).over(document).alias(f"d{t}") for t in parts]
    scored = scored.select("*", F.collect_list(single).over(document).alias("alone"), *totals)
    whole = []
    for f in classes[:-1]:
        there = [(F.col(f"d{t}") >= CONFIRMED).cast("int") for t in texts_of[f]]
        share = reduce(lambda a, b: a + b, there) / len(there) if there else F.lit(0.0)
        whole.append(F.when(share >= CONFIRMED, share).otherwise(0.0))
    votes = F.transform(
        "fit",
        lambda c: F.struct(
            (F.size(F.filter("alone", lambda x: x == c)) * 2.0 + F.get(F.col("whole"), c)).alias("n"),
            c.alias("c"),
        ),
    )

    def winner(vs):
        most = F.array_max(F.transform(vs, lambda v: v["n"]))
        won = let(most, lambda n: F.filter(vs, lambda v: v["n"] == n))
        return let(won, lambda w: F.when(F.size(w) == 1, F.get(w, F.lit(0))["c"]))

    top = F.array_max("margins")
    total = let(
        top, lambda t: F.aggregate("margins", F.lit(0.0), lambda s, m: s + F.exp(m - t))
    )
    chosen = F.coalesce(let(votes, winner), F.lit(len(of)))
    return (
        scored.withColumn("whole", F.array(*whole))
        .withColumn("chosen", chosen)
        .select(
            F.col("key").alias(key),
            "paragraph",
            F.get(F.array(*map(F.lit, classes)), F.col("chosen")).alias("licence"),
            (F.exp(F.get("margins", F.col("chosen")) - top) / total).alias("probability"),
            F.coalesce(F.get("fits", F.col("chosen")), F.array_max("fits")).alias("similarity"),
        )
    )


def licences(
    spark: SparkSession, docs: DataFrame, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Trains and scans in one call."""
    return scan_licences(docs, train_licences(docs, text), key, text)
