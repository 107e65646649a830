import re
from itertools import groupby

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ringcast.llm.quality_rules import CLOSING, judge, line_verdicts
from ringcast.llm.texts import Texts

WORD = re.compile(r"[^\x20\x09-\x0D]+")
texts = st.lists(
    st.one_of(st.none(), st.text(alphabet="aé|!# \n\tß漢", max_size=60)), min_size=1, max_size=8
)


def of(rows):
    return Texts.of(pa.array(rows, pa.string()))


@settings(max_examples=200, deadline=None)
@given(texts)
def test_words_lines_and_shingles(rows):
    t = of(rows)
    starts, ends, owner = t.words
    got = [[] for _ in rows]
    for s, e, o in zip(starts, ends, owner):
        got[o].append(t.data[s:e].tobytes().decode())
    assert got == [WORD.findall(r or "") for r in rows]
    starts, ends, owner = t.lines
    lines = [[] for _ in rows]
    for s, e, o in zip(starts, ends, owner):
        lines[o].append(t.data[s:e].tobytes().decode())
    assert lines == [(r or "").split("\n") for r in rows]
    hashes, owner, _ = t.shingles(3)
    value = {}
    for i, r in enumerate(rows):
        w = WORD.findall(r or "")
        wanted = [tuple(w[j : j + 3]) for j in range(len(w) - 2)] or ([tuple(w)] if w else [])
        mine = hashes[owner == i].tolist()
        assert len(mine) == len(wanted)
        for shingle, h in zip(wanted, mine):
            assert value.setdefault(shingle, h) == h
    assert len(set(value.values())) == len(value)


def brute_base(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    runs = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    covered = {
        i + j for i, r in enumerate(runs) if runs.count(r) > 1 for j in range(5)
    }
    return [
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)),
        len(covered),
    ]


@settings(max_examples=200, deadline=None)
@given(texts)
def test_counts_match_brute_force(rows):
    got = np.array([np.asarray(x, np.int64) for x in judge(of(rows))[:5]]).T.tolist()
    assert got == [brute_base(r) for r in rows]


@pytest.mark.parametrize(
    "line, rule",
    [
        ("one** two## three$$ four%%", "symbols"),
        ("THE!! ONE!! AND!! ONLY!!", "shouting"),
        ("Home | News | Sport | Weather", "navigation"),
        ("Copyright by us, all RIGHTS reserved", "boilerplate"),
        ("Home » News » Sport", "navigation"),
        ("Accueil · Actualités · Sport · Météo", "navigation"),
        ("Tous droits réservés par nous.", "boilerplate"),
        ("Hier stehen unsere Nutzungsbedingungen.", "boilerplate"),
        ("Lea la política de privacidad.", "boilerplate"),
        ("A plain line of words, and no more!", None),
        ("A heading", None),
    ],
)
def test_line_rules(line, rule):
    found = line_verdicts(of(["A first line.\n" + line]))
    names = ["symbols", "shouting", "navigation", "menu", "boilerplate"]
    assert [n for n in names if found[n][1]] == ([rule] if rule else [])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="a. …»é\n\t", max_size=60)), min_size=1, max_size=8))
def test_menus_match_brute_force(rows):
    got = line_verdicts(of(rows))["menu"].tolist()
    wanted = []
    for r in rows:
        lines = (r or "").split("\n")
        bare = [len(WORD.findall(x)) <= 7 and WORD.findall(x)[-1][-1] not in CLOSING
                for x in lines if WORD.search(x)]
        menu = []
        for flag, run in groupby(bare):
            n = len(list(run))
            menu += [flag and n >= 3] * n
        left = iter(menu)
        wanted += [next(left) if WORD.search(x) else False for x in lines]
    assert got == wanted


@pytest.mark.parametrize(
    "text",
    ["\n".join(f"Menu item {i}" for i in range(30)),
     "\n".join(f"five words and no stop{i}" for i in range(30)),
     "\n".join(["Tous droits réservés", "Cliquez ici pour lire", "Politique de confidentialité",
                "Accepter les cookies", "Conditions d'utilisation", "Partager sur Facebook"]),
     "\n".join(["Alle Rechte vorbehalten", "Hier klicken bitte", "Datenschutzerklärung",
                "Cookies akzeptieren", "Nutzungsbedingungen lesen", "Newsletter abonnieren"])],
)
def test_page_furniture_is_rejected(text):
    assert not judge(of([text]))[-1][0]


def test_rejects_texts_that_lose_much():
    plain = " ".join(f"word{i}" for i in range(40))
    bad = " | ".join(f"menu{i}" for i in range(40))
    kept = judge(of([plain, plain + "\n" + bad, plain + "\nHome | Menu", None, ""]))[-1]
    assert kept.tolist() == [True, False, True, False, False]


def test_a_worker_puts_away_what_a_task_does_not_use():
    from ringcast.llm.texts import Shelf, end_of_task

    made = []
    one, other = Shelf(), Shelf()
    for _ in range(2):  # two tasks that use it
        assert one.get("a", lambda: made.append(1) or [1]) == [1]
        end_of_task()
    assert made == [1] and one.value == [1]
    assert other.get("b", lambda: [2]) == [2]
    end_of_task()
    assert one.value is None and other.value == [2]
    assert other.get("c", lambda: [3]) == [3]
