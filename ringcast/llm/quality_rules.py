"""Line-first cleaning: bad lines are taken out, texts that lose too much are rejected.

A line with a word fails a rule when

* symbols: over a tenth of the characters in its words are of ``#*$%&<>``;
* shouting: over a tenth of the characters in its words are exclamation marks;
* navigation: it holds two separators (``| > » › · •``) or more, one for every four words
  at least;
* menu: it is one of three or more lines in a row, lines without words passed over, that
  have seven words at most and no closing punctuation;
* boilerplate: it equals an earlier line of the text, or holds a stock phrase.

A text is rejected if its failed lines hold more than ``max_lost`` of the characters
of its words, or if it fails a rule on the whole text (fewer than 10 words, or a fifth
of its words in repeated runs of five).  Null and empty texts have no words and are
rejected; every row is judged alone, so repeated rows and ties need no rule.  Texts of any
length are read whole, an empty table gives an empty result, and other columns are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from ringcast.llm.texts import Texts, mix, over_texts

#: Stock phrases of page furniture in English, French, German and Spanish, in ASCII and cut
#: at accents; matched in any case.  Fixed values.
PHRASES = (
    "all rights reserved",
    "accept cookies",
    "cookie policy",
    "privacy policy",
    "terms of service",
    "terms of use",
    "click here",
    "enable javascript",
    "share on facebook",
    "share on twitter",
    "subscribe to our newsletter",
    "skip to content",
    "tous droits r",
    "accepter les cookies",
    "politique de confidentialit",
    "conditions d'utilisation",
    "cliquez ici",
    "partager sur facebook",
    "aller au contenu",
    "alle rechte vorbehalten",
    "cookies akzeptieren",
    "datenschutzerkl",
    "nutzungsbedingungen",
    "hier klicken",
    "auf facebook teilen",
    "newsletter abonnieren",
    "zum inhalt springen",
    "todos los derechos reservados",
    "aceptar cookies",
    "aceptar las cookies",
    "tica de privacidad",
    "haga clic aqu",
    "compartir en facebook",
    "saltar al contenido",
)
SEPARATORS = "|>»›·•"
CLOSING = ".!?:;,\"')]}…”’»。！？"
MENU_WORDS, MENU_LINES = 7, 3
MIN_WORDS, REPEAT_PERCENT, RUN = 10, 20, 5
MAX_LOST = 0.3

_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True

NEW = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
    "n_repeat_words bigint, n_lines bigint, n_failed_lines bigint, lost_chars bigint, "
    "base_failed boolean, kept boolean"
)


def repeats(keys: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which keys occur twice or more in their text, and which occurred earlier in it."""
    both = mix(keys + mix(owner.astype(np.uint64)))
    order = np.argsort(both, kind="stable")
    ranked = both[order]
    same = ranked[1:] == ranked[:-1]
    later = np.zeros(len(keys), bool)
    later[order[1:]] = same
    twice = later.copy()
    twice[order[:-1]] |= same
    return twice, later


def repeated_words(texts: Texts) -> np.ndarray:
    """Words of each text that lie in a run of five words found twice or more in it."""
    owner = texts.words[2]
    counts = np.bincount(owner, minlength=len(texts))
    hashes, of, at = texts.shingles(RUN)
    full = counts[of] >= RUN
    twice, _ = repeats(hashes[full], of[full])
    starts = at[full][twice]
    cover = np.zeros(len(owner) + 1, np.int64)
    np.add.at(cover, starts, 1)
    np.add.at(cover, starts + RUN, -1)
    return np.bincount(owner[np.cumsum(cover[:-1]) > 0], minlength=len(texts))


def _stock_phrases(lowered: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of every stock phrase."""
    at, length = [], []
    for phrase in PHRASES:
        found = lowered.find(wanted := phrase.encode())
        while found >= 0:
            at.append(found)
            length.append(len(wanted))
            found = lowered.find(wanted, found + 1)
    return np.array(at, np.int64), np.array(length, np.int64)


def _characters(data: np.ndarray, wanted: str) -> np.ndarray:
    """Whether each byte is the last of one of the wanted characters."""
    found = np.zeros(len(data), bool)
    for raw in map(str.encode, wanted):
        here = data == raw[-1]
        for back in range(1, len(raw)):
            here[back:] &= data[:-back] == raw[-1 - back]
            here[:back] = False
        found |= here
    return found


def in_menus(texts: Texts, words: np.ndarray) -> np.ndarray:
    """Lines that are short, without closing punctuation and in a row of such lines."""
    _, ends, owner = texts.lines
    at = np.flatnonzero(words > 0)
    last = texts.words[1][np.searchsorted(texts.words[0], ends[at]) - 1] - 1
    bare = (words[at] <= MENU_WORDS) & ~_characters(texts.data, CLOSING)[last]
    new = np.ones(len(at), bool)
    new[1:] = (bare[1:] != bare[:-1]) | (owner[at][1:] != owner[at][:-1])
    row = np.cumsum(new) - 1
    out = np.zeros(len(words), bool)
    out[at] = bare & (np.bincount(row)[row] >= MENU_LINES) if len(at) else False
    return out


def line_verdicts(texts: Texts) -> dict[str, np.ndarray]:
    """For each line: its span and text, characters in words, and the rules it fails."""
    starts, ends, owner = texts.lines
    data = texts.data
    begins = np.zeros(len(data), bool)
    begins[texts.words[0]] = True

    def count(marks):
        return texts.per_span(marks, starts, ends)

    words, chars = count(begins), count(texts.points & ~texts.space)
    pipes = count(data == ord("|"))
    separators = count(_characters(data, SEPARATORS))
    symbols = count(_SYMBOLS[data]) - pipes
    filled = words > 0
    earlier = np.zeros(len(starts), bool)
    hashes = texts.hashes(starts[filled], ends[filled])
    earlier[filled] = repeats(hashes, owner[filled])[1]
    stock = np.zeros(len(starts), bool)
    at, length = _stock_phrases(data.tobytes().lower())
    line = np.searchsorted(starts, at, side="right") - 1
    # a match over the edge of two texts belongs to no line
    stock[line[at + length <= ends[line]]] = True
    return {
        "start": starts,
        "end": ends,
        "text": owner,
        "words": words,
        "chars": chars,
        "duplicate": earlier,
        "symbols": filled & (10 * symbols > chars),
        "shouting": filled & (10 * count(data == ord("!")) > chars),
        "navigation": (separators >= 2) & (4 * separators >= words),
        "menu": in_menus(texts, words),
        "boilerplate": earlier | stock,
    }


RULES = ("symbols", "shouting", "navigation", "menu", "boilerplate")


def judge(texts: Texts, max_lost: float = MAX_LOST) -> list[np.ndarray]:
    n = len(texts)
    n_words = np.bincount(texts.words[2], minlength=n)
    chars = texts.per_text(texts.points & ~texts.space)
    lines = line_verdicts(texts)
    failed = np.logical_or.reduce([lines[r] for r in RULES])
    lost = np.bincount(lines["text"], weights=failed * lines["chars"], minlength=n)
    lost = lost.astype(np.int64)
    repeat = repeated_words(texts)
    base = (n_words < MIN_WORDS) | (100 * repeat > REPEAT_PERCENT * n_words)
    return [
        n_words,
        chars,
        texts.per_text(_SYMBOLS[texts.data]),
        np.bincount(lines["text"][lines["duplicate"]], minlength=n),
        repeat,
        np.bincount(lines["text"][lines["words"] > 0], minlength=n),
        np.bincount(lines["text"][failed], minlength=n),
        lost,
        base,
        ~base & (lost <= max_lost * chars),
    ]


def quality_rules(
    docs: DataFrame, keep: list[str], text: str = "text", max_lost: float = MAX_LOST
) -> DataFrame:
    """Counts and verdict of every row; see the module for the rules."""
    return over_texts(docs, keep, NEW, lambda _, t: judge(t, max_lost), text)


def cleaned_texts(
    docs: DataFrame, keep: list[str], text: str = "text", max_lost: float = MAX_LOST
) -> DataFrame:
    """Kept rows with their text freed of failed lines, in ``clean_text``."""

    def compute(_, texts):
        lines = line_verdicts(texts)
        good = ~np.logical_or.reduce([lines[r] for r in RULES])
        out: list[list[bytes]] = [[] for _ in range(len(texts))]
        spans = (lines["text"][good], lines["start"][good], lines["end"][good])
        for i, a, b in zip(*(x.tolist() for x in spans), strict=True):
            out[i].append(texts.data[a:b].tobytes())
        joined = [b"\n".join(x).decode("utf-8") for x in out]
        return [judge(texts, max_lost)[-1], joined]

    made = over_texts(docs, keep, "kept boolean, clean_text string", compute, text)
    return made.where("kept").drop("kept")
