"""Toxicity scores of texts whose words may be disguised.

Noisy channel: a disguised word is taken as a plain one that was written with digits and
signs for letters, with letters repeated, or with its letters set apart.  The readings
of a word form a lattice, each step costing what its disguise is worth; a Viterbi search
finds the reading that is likeliest under a character trigram model.  Words with one
reading only, letters alone and none twice in a row, are their own result.  A sign at a
word's edge may be a letter or no part of the word: the reading that is a word of the
learning texts is taken, and if both are, a digit or currency sign is a letter and a
punctuation mark is not.  Invisible characters are left out, and Cyrillic or Greek letters
that look like Latin ones are read as those in a word that has Latin letters too.

The restored words are scored by a logistic regression over whole words and their
beginnings: of those, the ones that the learning rows tie most to the label.

The channel's costs are fixed; language model and classifier learn from all labelled rows,
whole texts.  Equal texts teach once; rows with an unknown or contradictory label teach
nothing.
Null and empty texts have no word and get the base score.  Every row is scored alone and
whole; an empty table gives an empty result, and learning rows without both labels raise
ValueError.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringcast.llm.near_dedup import row_filter, with_maybe
from ringcast.llm.tables import agreed_labels
from ringcast.llm.texts import Shelf, over_texts
from ringcast.session import stage

#: Letters that a digit or sign may stand for.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t",
    "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "li", "+": "t", "€": "e", "(": "c",
}
#: Letters of other scripts that look like Latin ones.
LOOKALIKES = {
    "а": "a", "е": "e", "і": "i", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "ѕ": "s",
    "ј": "j", "к": "k", "м": "m", "т": "t", "ԁ": "d", "α": "a", "ο": "o", "ι": "i", "ν": "v",
}
SIGN_COST, DROP_COST, REPEAT_COST, SPACE_COST = 1.0, 4.0, 0.5, 1.0  # nats
MAX_FEATURES, MIN_ROWS, CANDIDATES = 6000, 4, 200_000
RIDGE = 5e-5
PREFIXES = (3, 4, 5, 6)
MAX_TRIGRAMS, MAX_WORDS, MIN_TIMES = 100_000, 50_000, 3
CACHED_WORDS, CACHED_CHARS = 400_000, 64
TALLIED_BYTES = 2_000_000  # of text whose words are summed before they are shuffled

_EDGES = " \t\n\r\x0b\x0c.,;:?!\"'()[]{}<>#*%&=~^`/\\|-_«»„“”¿¡…"
_sign = re.compile("[" + re.escape("".join(LEET)) + "]")
_letter = re.compile(r"[^\W\d_]")
_repeated = re.compile(r"(.)\1\1")
_doubled = re.compile(r"([^\W\d_])\1")
# letters set apart may stand in quotes or brackets, and before closing punctuation
_open, _close = r"(?<![^\s\"'()\[{<«„“‘¿¡])", r"(?![^\s\"')\]}>»“”’.,;:?!…])"
_gap = r"(?:\s+(?:[.\-_*]\s*)?|[.\-_*](?:[.\-_*]|\s+)?)"
_apart = re.compile(_open + r"[^\W_](?:" + _gap + r"[^\W_@$!|]){2,}" + _close + "|" +
                    _open + r"[\w@$!|](?:\s+[\w@$!|]){2,}" + _close)
# the end of any match of ``_apart``, which takes a fifth of its time to look for
_maybe_apart = re.compile(
    r"[\s.\-_*](?:[^\W_][\s.\-_*]++[^\W_]|[\w@$!|]\s++[\w@$!|])" + _close
)
_joined = re.compile(r"[\w@$!|](?:[.\-_*/]{1,3}[\w@$!|]){2,}")
_hidden = re.compile("[\u00ad\u200b-\u200f\u2060\ufeff]")
_foreign = re.compile("[" + "".join(LOOKALIKES) + "]")
_latin = re.compile("[a-z]")
_look = str.maketrans(LOOKALIKES)
_words = re.compile(r"[^\x20\x09-\x0D]+")


@dataclass
class CharacterModel:
    """Trigrams of lower-case letters, a space before and after each word; known words."""

    counts: dict[str, int]
    costs: dict[str, float] = field(default_factory=dict)
    words: frozenset[str] = frozenset()

    def __post_init__(self):
        self.pairs: Counter = Counter()
        self.starts: Counter = Counter()
        self.single: Counter = Counter()
        self.contexts: Counter = Counter()
        for gram, n in self.counts.items():
            self.contexts[gram[:2]] += n
            self.pairs[gram[1:]] += n
            self.starts[gram[1]] += n
            self.single[gram[2]] += n
        self.total = sum(self.single.values())

    def cost(self, before: str, letter: str) -> float:
        """-log p(letter | two characters before), smoothed by shorter contexts."""
        gram = before + letter
        known = self.costs.get(gram)
        if known is None:
            one = (self.single[letter] + 0.1) / (self.total + 10)
            two = (self.pairs[gram[1:]] + 5 * one) / (self.starts[before[1]] + 5)
            three = (self.counts.get(gram, 0) + 5 * two) / (self.contexts[before] + 5)
            known = self.costs[gram] = -math.log(three)
        return known

    def likeliest(self, lattice: list[list[tuple[str, float]]]) -> str:
        """The cheapest reading: one option of each step, and the end of a word."""
        known_cost = self.costs.get
        paths: dict[str, tuple[float, tuple | None]] = {"  ": (0.0, None)}
        for options in [*lattice, [(" ", 0.0)]]:
            after: dict[str, tuple[float, tuple | None]] = {}
            for state, (cost, path) in paths.items():
                for text, extra in options:
                    end, total = state, cost + extra
                    for c in text:
                        gram = end + c
                        more = known_cost(gram)
                        total += self.cost(end, c) if more is None else more
                        end = gram[1:]
                    known = after.get(end)
                    if known is None or total < known[0]:
                        after[end] = total, (path, text)
            paths = after
        _, path = min(paths.values(), key=lambda x: x[0])
        parts = []
        while path is not None:
            path, text = path
            parts.append(text)
        return "".join(reversed(parts)).strip()


def lattice_of(word: str, gaps: bool, drop: bool = True) -> list[list[tuple[str, float]]]:
    """Readings of each run of one character; ``gaps``: signs between letters set apart;
    ``drop``: signs at the edges may be no letters."""
    return list(_runs(word, gaps, drop))


def _runs(word: str, gaps: bool, drop: bool = True) -> Iterator[list[tuple[str, float]]]:
    at = 0
    while at < len(word):
        c = word[at]
        end = at
        while end < len(word) and word[end] == c:
            end += 1
        n, at = end - at, end
        if gaps and (c.isspace() or c in ".-_*/"):
            yield [("", 0.0), (" ", SPACE_COST)]
        elif c in LEET:
            options = [(x, SIGN_COST) for x in LEET[c]]
            if drop and (end == len(word) or end == n):  # at the edge it may be no letter at all
                options.append(("", DROP_COST))
            if n > 1:
                options += [(x + x, SIGN_COST) for x in LEET[c]]
            yield options
        elif n >= 3:
            yield [(c, REPEAT_COST), (c + c, REPEAT_COST)]
        elif n == 2 and c.isalpha():
            yield [(c + c, 0.0), (c, REPEAT_COST)]
        else:
            yield [(c * n, 0.0)]


def _reading(core: str, model: CharacterModel) -> str:
    """The likeliest reading; of two that differ in signs at the edges, the known word."""
    likeliest = model.likeliest(lattice_of(core, False))
    at_edge = [c for c in (core[0], core[-1]) if c in LEET]
    if not at_edge:
        return likeliest
    letters = model.likeliest(lattice_of(core, False, drop=False))
    if letters not in model.words:
        return likeliest
    if all(c in "!|(" for c in at_edge):  # more often punctuation than letters
        bare = model.likeliest(lattice_of(core.strip("!|("), False))
        return bare if bare in model.words else letters
    return letters


PLAIN, SIGNS, APART = range(3)


def _core(word: str) -> tuple[str, int]:
    """What of a word is read, in lower case, and how: as it is, for the signs and repeated
    letters in it, or as letters set apart."""
    if word.isascii():
        low = word.lower()
    else:
        low = _hidden.sub("", word).lower()
        if _foreign.search(low) and _latin.search(low):
            low = low.translate(_look)
    core = low.strip(_EDGES)
    if not core.isalpha():
        if _joined.fullmatch(core):
            return core, APART
        if not _letter.search(core):
            return core, PLAIN
    if core[0] != low[0]:
        # a sign before the word may be its first letter
        lead = low[: low.find(core)]
        if lead[-1] in "!|(":
            core = lead[-1] + core
    if core.isalpha():
        return core, SIGNS if _doubled.search(core) else PLAIN
    if _sign.search(core) or _repeated.search(core) or _doubled.search(core):
        return core, SIGNS
    return core, PLAIN


def _read(core: str, how: int, model: CharacterModel) -> str:
    if how == PLAIN:
        return core
    return _reading(core, model) if how == SIGNS else model.likeliest(lattice_of(core, True))


def restore(word: str, model: CharacterModel) -> str:
    """The plain reading of one word, in lower case, without signs at its edges."""
    return _read(*_core(word), model)


def _may_begin(core: str, number: dict[str, int], stems: set[str]) -> bool:
    """Whether a reading of a word may have a feature: these all begin the word and a space."""
    live = {""}
    for options in chain(_runs(core, False), [[(" ", 0.0)]]):
        longer = set()
        for x in live:
            for text, _ in options:
                end = x
                for c in text:
                    end += c
                    if end in number:
                        return True
                    if end not in stems:
                        break
                else:
                    longer.add(end)
        if not longer:
            return False
        live = longer
    return False


def restored_text(text: str, model: CharacterModel) -> str:
    """A whole text with its words restored; words set apart become one."""
    spaced = _apart.sub(lambda m: model.likeliest(lattice_of(m[0].lower(), True)), text)
    return _words.sub(lambda m: restore(m[0], model) or m[0], spaced)


def word_features(restored: str) -> set[str]:
    out = set()
    for word in restored.split():
        out.add(f"{word} ")
        out.update(word[:n] for n in PREFIXES if len(word) >= n)
    return out


class _Known(dict):
    """Words, in UTF-8, to the numbers of their features; of bounded size.

    Words without a feature, most of all, are in the set ``nothing``.  When half of the
    bounded size is full, it becomes the older half and the former older half is forgotten;
    a word met again moves back, so frequent words stay.
    """

    def __init__(self, model: CharacterModel, number: dict[str, int] | None):
        super().__init__()
        self.model, self.number = model, number
        self.nothing: set[bytes] = set()
        self.older: set[bytes] = set()
        # every feature begins like its word
        self.heads = None if number is None else {f[:3] for f in number}
        self.stems = {f[:n] for f in number or () for n in range(1, len(f) + 1)}

    def of(self, restored: str) -> tuple:
        number, heads = self.number, self.heads
        if number is None:
            return tuple(word_features(restored))
        out = []
        for word in restored.split():
            whole = f"{word} "
            if whole[:3] in heads:
                begins = [word[:n] for n in PREFIXES if len(word) >= n]
                out += [number[f] for f in (whole, *begins) if f in number]
        return tuple(out)

    def of_word(self, word: str) -> tuple:
        core, how = _core(word)
        if how == SIGNS and self.heads is not None and core.split() == [core]:
            # no reading has to be found if none has a feature
            bare = core.strip("!|(")
            if not _may_begin(core, self.number, self.stems) and (
                bare == core or not _may_begin(bare, self.number, self.stems)
            ):
                return ()
        return self.of(_read(core, how, self.model))

    def __missing__(self, word: bytes) -> tuple:
        made = () if word in self.older else self.of_word(word.decode())
        if len(word) > CACHED_CHARS:
            return made
        if made:
            if len(self) >= CACHED_WORDS:
                self.clear()
            self[word] = made
        else:
            if len(self.nothing) >= CACHED_WORDS // 2:
                self.older, self.nothing = self.nothing, set()
            self.nothing.add(word)
        return made

    def in_text(self, text: str) -> set:
        """Features of a whole text, each once."""
        out = set()
        # bytes are split at ASCII white space only
        for word in set(text.encode().split()).difference(self.nothing):
            out.update(self[word])
        if _maybe_apart.search(text):
            for m in _apart.finditer(text):
                out.update(self.of(self.model.likeliest(lattice_of(m[0].lower(), True))))
        return out


@dataclass(eq=False)
class ToxicityModel:
    characters: CharacterModel
    number: dict[str, int]
    weights: np.ndarray
    bias: float

    def scorer(self) -> _Known:
        return _Known(self.characters, self.number)

    def score(self, features: set) -> float:
        margin = self.bias + float(self.weights[sorted(features)].sum())
        return 1 / (1 + math.exp(-min(30.0, max(-30.0, margin))))


def _tallies(some: DataFrame, text: str, count) -> DataFrame:
    """Sums by name of what ``count(texts)`` gives for the rows of each label, pre-summed."""

    def compute(part, _):
        sums: dict[str, list[int]] = {}
        texts, labels = part.column(text).to_pylist(), part.column("label").to_pylist()
        for label in (0, 1):
            own = [t or "" for t, x in zip(texts, labels, strict=True) if x == label]
            for name, n in count(own):
                sums.setdefault(name, [0, 0])[label] += n
        # the first row carries the sums of all rows of the slice
        empty = [[] for _ in range(len(part) - 1)]
        names = list(sums)
        return [
            [names, *empty],
            [[sums[k][0] for k in names], *empty],
            [[sums[k][1] for k in names], *empty],
        ]

    new = "names array<string>, clean array<bigint>, toxic array<bigint>"
    zipped = F.explode(F.arrays_zip("names", "clean", "toxic")).alias("x")
    return (
        over_texts(some, ["label"], new, compute, text, TALLIED_BYTES)
        .select(zipped)
        .groupBy(F.col("x.names").alias("name"))
        .agg(F.sum("x.clean").alias("clean"), F.sum("x.toxic").alias("toxic"))
    )


def _whole_words(texts: list[str]):
    raw: Counter = Counter()
    for t in texts:
        raw.update(t.encode().split())
    found: Counter = Counter()
    for word, n in raw.items():
        word = word.decode().lower().strip(_EDGES)
        if word.isalpha() and not _repeated.search(word):
            found[word] += n
    return found.items()


def _character_model(some: DataFrame, text: str) -> CharacterModel:
    """Trigrams and frequent words, from the numbers of times that each word is there."""
    words = stage(
        _tallies(some, text, _whole_words).select(
            "name", (F.col("clean") + F.col("toxic")).alias("times")
        ),
        "toxicity-words",
    )
    padded = F.concat(F.lit("  "), "name", F.lit(" "))
    grams = F.transform(
        F.sequence(F.lit(1), F.char_length("name") + 1), lambda i: F.substring(padded, i, F.lit(3))
    )
    grams = words.select(F.explode(grams).alias("name"), "times")
    most = grams.groupBy("name").agg(F.sum("times").alias("times"))
    most = most.orderBy(F.desc("times"), "name").limit(MAX_TRIGRAMS).collect()
    known = words.where(F.col("times") >= MIN_TIMES).orderBy(F.desc("times"), "name")
    return CharacterModel(
        {r.name: r.times for r in most},
        words=frozenset(r.name for r in known.limit(MAX_WORDS).collect()),
    )


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    key: str = "doc_id",
    text: str = "text",
    candidates: int = CANDIDATES,
) -> ToxicityModel:
    """Learns from all ``labels`` (key and label) that have a row in ``docs``.

    The driver gets counts of letter trigrams, the most frequent words, the features looked
    for in all rows, and a weight for each of the MAX_FEATURES most tied to the label.
    Looked for are the ``candidates`` features that most toxic rows hold, and more if one
    that was left out could be tied more than one that was taken.
    """
    agreed = agreed_labels(labels, key, label).where(F.col("label").isin(0, 1))
    # labels meet digests; texts are shuffled only of rows that teach, and once
    digest = F.coalesce(F.unhex(F.sha2(F.col(text), 256)), F.unhex(F.lit("")))
    read = docs.select(key, text)
    equal = read.select(key, digest.alias("_digest")).join(agreed, key)
    equal = equal.groupBy("_digest").agg(
        F.min(key).alias(key), F.min("label").alias("label"), F.max("label").alias("_other")
    )
    chosen = stage(equal.where("label = _other").drop("_other"), "toxicity-chosen")
    maybe = with_maybe(read, row_filter(chosen, key), key).where("_maybe").drop("_maybe")
    some = maybe.withColumn("_digest", digest).join(chosen.hint("merge"), [key, "_digest"])
    # rows alike in key and text are one
    some = some.dropDuplicates([key, "_digest"]).drop("_digest")
    some = stage(some, "toxicity-learning")
    sizes = {r.label: r["count"] for r in some.groupBy("label").count().collect()}
    if not sizes.get(0) or not sizes.get(1):
        raise ValueError("learning rows of both labels are needed")

    characters = _character_model(some, text)
    shared = docs.sparkSession.sparkContext.broadcast(characters)

    def present(texts):
        known = _Known(shared.value, None)
        found: Counter = Counter()
        for t in texts:
            found.update(known.in_text(t))
        return found.items()

    in_toxic = stage(
        _tallies(some.where("label = 1"), text, present)
        .where(F.col("toxic") >= MIN_ROWS)
        .select("name", "toxic"),
        "toxicity-names",
    )

    def gain(toxic, clean):
        rate_1, rate_0 = (toxic + 0.5) / (sizes[1] + 1.0), (clean + 0.5) / (sizes[0] + 1.0)
        return toxic * math.log(rate_1 / rate_0) if rate_1 > 4 * rate_0 else 0.0

    while True:
        looked = in_toxic.orderBy(F.desc("toxic"), "name").limit(candidates).collect()
        rows = stage(_held(some, characters, [r.name for r in looked], key, text), "toxicity-rows")
        clean = dict(
            rows.where("label = 0").select(F.explode("features").alias("f"))
            .groupBy("f").count().collect()
        )
        tied = [(gain(r.toxic, clean.get(i, 0)), r.name, i) for i, r in enumerate(looked)]
        tied = sorted((x for x in tied if x[0] > 0), key=lambda x: (-x[0], x[1]))[:MAX_FEATURES]
        if len(looked) < candidates:
            break
        if len(tied) == MAX_FEATURES and tied[-1][0] > gain(looked[-1].toxic, 0):
            break
        candidates *= 4

    number = {name: i for i, (_, name, _) in enumerate(tied)}
    if not tied:
        share = sizes[1] / (sizes[0] + sizes[1])
        return ToxicityModel(characters, number, np.zeros(0), math.log(share / (1 - share)))
    vectors = CountVectorizerModel.from_vocabulary(
        [str(i) for *_, i in tied], inputCol="names", outputCol="vector"
    ).setBinary(True)
    named = rows.select("label", F.col("features").cast("array<string>").alias("names"))
    learned = LogisticRegression(
        featuresCol="vector", labelCol="label", regParam=RIDGE, standardization=False
    ).fit(vectors.transform(named).select("label", "vector"))
    return ToxicityModel(characters, number, learned.coefficients.toArray(), learned.intercept)


def _held(
    some: DataFrame, characters: CharacterModel, names: list[str], key: str, text: str
) -> DataFrame:
    """Key, label and the numbers of the features that each learning row holds."""
    model = ToxicityModel(characters, {f: i for i, f in enumerate(names)}, np.zeros(0), 0.0)
    shared = some.sparkSession.sparkContext.broadcast(model)

    def compute(part, _):
        known = _scorer(shared)
        return [[sorted(known.in_text(t or "")) for t in part.column(text).to_pylist()]]

    return over_texts(some, [key, "label"], "features array<bigint>", compute, text)


def score_toxicity(
    docs: DataFrame, model: ToxicityModel, keep: list[str], text: str = "text"
) -> DataFrame:
    """Columns ``keep`` of every row, with ``score`` and ``predicted``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of bounded size

    def compute(part, _):
        known = _scorer(shared)
        score = [
            shared.value.score(known.in_text(t or "")) for t in part.column(text).to_pylist()
        ]
        score = np.array(score, np.float64)
        return [score, (score >= 0.5).astype(np.int32)]

    return over_texts(docs, keep, "score double, predicted int", compute, text)


def restore_texts(
    docs: DataFrame, model: ToxicityModel, keep: list[str], text: str = "text"
) -> DataFrame:
    """Columns ``keep`` of every row, and its text restored in ``restored``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def compute(part, _):
        characters = shared.value.characters
        texts = [restored_text(t or "", characters) for t in part.column(text).to_pylist()]
        return [pa.array(texts, pa.string())]

    return over_texts(docs, keep, "restored string", compute, text)


_known = Shelf()


def _scorer(shared) -> _Known:
    """One cache of words per broadcast model and worker process."""
    model = shared.value
    return _known.get(model, model.scorer)
