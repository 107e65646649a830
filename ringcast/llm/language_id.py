"""Language identification by a bidirectional gated recurrent network over bytes.

A text's UTF-8 bytes, in lower case, are cut into windows of ``SPAN``; a network with
gated recurrent units reads each window in both directions and gives every byte a
probability for each language.  A document's probabilities are the means over all its
bytes, so the whole text counts; its language is the likeliest one, the first in order
of name among equals, and its score that mean.

The network is trained in numpy by backpropagation through time on at most
``per_language`` learning rows of each language, with ``WINDOWS`` windows spread evenly
over each text; its only input is text.  Rows whose language is null, or differs between
rows of one key, teach nothing.  A text that is null or has no letter gets ``und`` and
score 0.  Every row is labelled alone, so repeated rows agree; an empty table gives an
empty result, and learning rows without a language raise ValueError.

With ``strange`` the network has one class more, for text in none of the languages.  It
learns that class from its own windows made strange: letters exchanged by a secret
alphabet, drawn at random or shuffled, and random letters of other scripts.  Half of the
chosen rows teach and the other half sets the bar: the share of the strange class that
``KEPT_ASIDE`` of them stay under, at least ``LEAST_BAR``.  Text above it gets ``und`` and
score 0.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringcast.llm.tables import sample_per_class
from ringcast.llm.texts import Texts, over_texts

SPAN, UNITS, WINDOWS = 64, 8, 8
PER_LANGUAGE, MAX_LANGUAGES = 250, 1000
UNDETERMINED = "und"
TOGETHER = 2048  # windows worked on at once
KEPT_ASIDE, LEAST_BAR = 0.99, 0.5
VOWELS = np.frombuffer(b"aeiou", np.uint8)
CONSONANTS = np.setdiff1d(np.arange(97, 123, dtype=np.uint8), VOWELS)
# first code points of other scripts, and how many letters are drawn from there on
SCRIPTS = {
    0x0370: 60, 0x0430: 60, 0x0590: 60, 0x0620: 60, 0x0900: 60, 0x0E00: 60,
    0x3040: 180, 0x4E00: 3000, 0xAC00: 3000,
}


def lowered(data: np.ndarray) -> np.ndarray:
    """Bytes with ASCII and Latin-1 capital letters made small."""
    out = data.copy()
    out[(data >= 65) & (data <= 90)] += 32
    if len(data) > 1:
        capital = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
        out[1:][capital] += 32
    return out


def _other_script(size: int, random) -> np.ndarray:
    """``size`` bytes of random words in a random script."""
    first = int(random.choice(list(SCRIPTS)))
    codes = first + random.integers(0, SCRIPTS[first], size)
    ends = random.random(size) < 0.2
    text = "".join(chr(c) + " " * e for c, e in zip(codes.tolist(), ends.tolist(), strict=True))
    return np.frombuffer(text.encode()[:size], np.uint8)


def made_strange(windows: np.ndarray, sizes: np.ndarray, random) -> np.ndarray:
    """Windows of the same sizes in no language; few or no letters may leave one as it is.

    Letters are a to z, and, for other alphabets, the later bytes of long characters.
    """
    out = windows.copy()
    small, later = np.arange(97, 123, dtype=np.uint8), np.arange(128, 192, dtype=np.uint8)
    for row, size, way in zip(out, sizes.tolist(), random.integers(0, 4, len(out)), strict=True):
        row = row[:size]
        if way == 3:
            row[:] = _other_script(size, random)
            continue
        if way == 0:
            secret = np.arange(256, dtype=np.uint8)
            for kind in (VOWELS, CONSONANTS, later):
                secret[kind] = random.permutation(kind)
            row[:] = secret[row]
            continue
        for kind in (small, later):
            at = np.flatnonzero((row >= kind[0]) & (row <= kind[-1]))
            row[at] = random.choice(kind, len(at)) if way == 1 else random.permutation(row[at])
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


@dataclass
class Direction:
    """One direction: ``table[:, byte]``, ``recur @ state`` and ``shift`` of three gates."""

    table: np.ndarray  # 3 UNITS x 256: update, reset, candidate
    recur: np.ndarray  # 3 UNITS x UNITS
    shift: np.ndarray  # UNITS x 1, inside the reset gate

    @classmethod
    def random(cls, seed) -> Direction:
        return cls(
            seed.normal(0, 0.3, (3 * UNITS, 256)).astype(np.float32),
            seed.normal(0, UNITS**-0.5, (3 * UNITS, UNITS)).astype(np.float32),
            np.zeros((UNITS, 1), np.float32),
        )

    def states(self, x: np.ndarray, inside: np.ndarray | None, steps: list[int], keep=None):
        """States after each step of ``x`` (step x window); 0 outside of the texts."""
        n, u = x.shape[1], UNITS
        out = np.empty((x.shape[0], u, n), np.float32)
        state = np.zeros((u, n), np.float32)
        for t in steps:
            given = np.take(self.table, x[t], axis=1)
            own = self.recur @ state
            gates = given[: 2 * u]
            gates += own[: 2 * u]
            gates = _sigmoid(gates)
            inner = own[2 * u :] + self.shift
            candidate = np.tanh(given[2 * u :] + gates[u:] * inner)
            if keep is not None:
                keep[t] = state, gates, inner, candidate
            state = candidate + gates[:u] * (state - candidate)
            if inside is not None:
                state = state * inside[t]
            out[t] = state
        return out

    def gradients(self, x, inside, steps, keep, slope):
        """Gradients of the parameters, given those of the states, last step first."""
        u = UNITS
        into = np.empty((x.shape[0], 3 * u, x.shape[1]), np.float32)
        recur, shift = np.zeros_like(self.recur), np.zeros_like(self.shift)
        back = np.zeros((u, x.shape[1]), np.float32)
        for t in reversed(steps):
            state, gates, inner, candidate = keep[t]
            d = slope[t] + back
            if inside is not None:
                d = d * inside[t]
            update, reset = gates[:u], gates[u:]
            a = d * (1 - update) * (1 - candidate**2)
            d_inner = a * reset
            both = np.concatenate(
                [
                    d * (state - candidate) * update * (1 - update),
                    a * inner * reset * (1 - reset),
                    d_inner,
                ]
            )
            back = d * update + self.recur.T @ both
            recur += both @ state.T
            shift += d_inner.sum(1, keepdims=True)
            into[t] = both
            into[t, 2 * u :] = a
        chosen = np.zeros((x.size, 256), np.float32)
        chosen[np.arange(x.size), x.ravel()] = 1
        table = into.transpose(1, 0, 2).reshape(3 * u, -1) @ chosen
        return [table, recur, shift]


@dataclass
class ByteNetwork:
    languages: list[str]
    ahead: Direction
    behind: Direction
    read_out: np.ndarray  # languages x 2 UNITS, and a last row for strange text if learned
    bias: np.ndarray  # languages x 1, likewise
    bar: float = 1.0  # text is in a language if the share of the strange class is not above

    def parameters(self) -> list[np.ndarray]:
        a, b = self.ahead, self.behind
        return [a.table, a.recur, a.shift, b.table, b.recur, b.shift, self.read_out, self.bias]

    def probabilities(self, x, inside, keep=None):
        """Step x language x window, and the states behind them."""
        steps = list(range(x.shape[0]))
        first, second = ({}, {}) if keep is None else keep
        recorded = (None, None) if keep is None else (first, second)
        states = np.concatenate(
            [
                self.ahead.states(x, inside, steps, recorded[0]),
                self.behind.states(x, inside, steps[::-1], recorded[1]),
            ],
            axis=1,
        )
        margin = np.matmul(self.read_out, states) + self.bias
        margin -= margin.max(1, keepdims=True)
        np.exp(margin, out=margin)
        margin /= margin.sum(1, keepdims=True)
        return margin, states

    @classmethod
    def train(
        cls, windows: np.ndarray, sizes: np.ndarray, labels: np.ndarray, languages: list[str],
        steps: int = 260, batch: int = 128, rate: float = 0.02, seed: int = 5,
        strange: bool = False,
    ) -> ByteNetwork:
        """Adam on the mean cross entropy of all bytes; each batch has all languages."""
        random = np.random.default_rng(seed)
        n = len(languages) + strange
        if strange:
            other = made_strange(windows, sizes, random)
            differs = (other != windows).any(1)
            windows = np.concatenate([windows, other[differs]])
            sizes = np.concatenate([sizes, sizes[differs]])
            labels = np.concatenate([labels, np.full(differs.sum(), n - 1)])
        net = cls(
            languages,
            Direction.random(random),
            Direction.random(random),
            random.normal(0, 0.3, (n, 2 * UNITS)).astype(np.float32),
            np.zeros((n, 1), np.float32),
        )
        mean = [np.zeros_like(p) for p in net.parameters()]
        spread = [np.zeros_like(p) for p in net.parameters()]
        by_label = [np.flatnonzero(labels == c) for c in range(n)]
        by_label = [rows for rows in by_label if len(rows)]
        for step in range(1, steps + 1):
            each = max(1, batch // len(by_label))
            some = np.concatenate([random.choice(rows, each) for rows in by_label])
            x = windows[some].T
            inside = (np.arange(SPAN)[:, None] < sizes[some]).astype(np.float32)[:, None]
            keep = ({}, {})
            wrong, states = net.probabilities(x, inside, keep)
            wrong[:, labels[some], np.arange(len(some))] -= 1
            wrong *= inside / max(1.0, float(inside.sum()))
            slope = np.matmul(net.read_out.T, wrong)
            order = list(range(SPAN))
            found = net.ahead.gradients(x, inside, order, keep[0], slope[:, :UNITS])
            found += net.behind.gradients(x, inside, order[::-1], keep[1], slope[:, UNITS:])
            found += [
                np.matmul(wrong, states.transpose(0, 2, 1)).sum(0),
                wrong.sum((0, 2))[:, None],
            ]
            pace = rate * (0.5 + 0.5 * np.cos(np.pi * step / steps))
            pace *= np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            for p, g, m, s in zip(net.parameters(), found, mean, spread, strict=True):
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                p -= pace * m / (np.sqrt(s) + 1e-8)
        return net

    def label(self, texts: Texts, visit) -> None:
        """Calls ``visit(text of each window, first byte, inside, probabilities)``."""
        data = lowered(texts.data)
        sizes = np.diff(texts.offsets)
        counts = -(-sizes // SPAN)
        of = np.repeat(np.arange(len(texts)), counts)
        place = np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)
        begins = texts.offsets[of] + place * SPAN
        lengths = np.minimum(SPAN, texts.offsets[of + 1] - begins)
        padded = np.concatenate([data, np.zeros(SPAN, np.uint8)])
        order = np.argsort(-lengths, kind="stable")
        for i in range(0, len(order), TOGETHER):
            some = order[i : i + TOGETHER]
            longest = int(lengths[some[0]])
            x = padded[begins[some] + np.arange(longest)[:, None]]
            inside = None
            if lengths[some[-1]] < longest:
                inside = np.arange(longest)[:, None] < lengths[some]
                inside = inside.astype(np.float32)[:, None]
            visit(of[some], begins[some], inside, self.probabilities(x, inside)[0])

    def pooled(self, texts: Texts) -> np.ndarray:
        """Mean probabilities of each text, text x class; 0 for empty ones."""
        total = np.zeros((len(texts), len(self.bias)))

        def visit(of, _, inside, p):
            np.add.at(total, of, (p if inside is None else p * inside).sum(0).T)

        self.label(texts, visit)
        return total / np.maximum(np.diff(texts.offsets), 1)[:, None]

    def labels(self, texts: Texts) -> np.ndarray:
        """The likeliest class of each byte of the texts, by number."""
        out = np.zeros(len(texts.data), np.int64)

        def visit(_, begins, inside, p):
            likeliest = p.argmax(1)
            at = begins + np.arange(len(likeliest))[:, None]
            valid = np.ones_like(at, bool) if inside is None else inside[:, 0] > 0
            out[at[valid]] = likeliest[valid]

        self.label(texts, visit)
        return out


def _windows(texts: Texts) -> list:
    """WINDOWS windows of each text, evenly spread, and their sizes."""
    data = lowered(texts.data)
    rows, sizes = [], []
    for a, b in zip(texts.offsets[:-1].tolist(), texts.offsets[1:].tolist(), strict=True):
        starts = sorted({a + max(0, b - a - SPAN) * i // (WINDOWS - 1) for i in range(WINDOWS)})
        parts = [data[s : min(b, s + SPAN)].tobytes() for s in starts if s < b]
        rows.append(b"".join(p.ljust(SPAN, b"\0") for p in parts))
        sizes.append([len(p) for p in parts])
    return [pa.array(rows, pa.binary()), sizes]


def train_languages(
    docs: DataFrame,
    lang: str = "lang",
    key: str = "doc_id",
    text: str = "text",
    per_language: int = PER_LANGUAGE,
    strange: bool = False,
) -> ByteNetwork:
    """Trains on ``docs``; the driver gets WINDOWS short windows of the chosen rows.

    With ``strange`` twice as many rows are chosen, and every other one sets the bar.
    """
    known = docs.where(F.col(lang).isNotNull() & (F.col(lang) != UNDETERMINED))
    found = known.select(lang).distinct().limit(MAX_LANGUAGES + 1).collect()
    languages = sorted(r[0] for r in found)
    if not 0 < len(languages) <= MAX_LANGUAGES:
        raise ValueError(f"learning rows need 1 to {MAX_LANGUAGES} languages")
    rows = known.where(F.col(text).rlike(r"\p{L}"))
    each = per_language * (1 + strange)
    chosen = sample_per_class(rows.select(key, lang), key, lang, each, languages)
    some = docs.select(key, text).join(F.broadcast(chosen), key)
    some = some.groupBy(key, "label").agg(F.min(text).alias(text))  # a key may have two texts
    got = over_texts(
        some, [key, "label"], "windows binary, sizes array<bigint>", lambda _, t: _windows(t), text
    ).collect()
    got.sort(key=lambda r: r[key])
    if not got:
        raise ValueError("learning rows need texts with letters")
    number = {name: i for i, name in enumerate(languages)}
    aside = []
    if strange:
        by_language = [[r for r in got if r.label == name] for name in languages]
        got = [r for rows in by_language for r in rows[::2]]
        aside = [r for rows in by_language for r in rows[1::2]]
    windows = np.frombuffer(b"".join(r.windows for r in got), np.uint8).reshape(-1, SPAN)
    sizes = np.array([s for r in got for s in r.sizes])
    labels = np.array([number[r.label] for r in got for _ in r.sizes])
    net = ByteNetwork.train(windows, sizes, labels, languages, strange=strange)
    if strange:
        found = net.pooled(_joined(aside))[:, -1]
        net.bar = max(LEAST_BAR, float(np.quantile(found, KEPT_ASIDE))) if len(found) else LEAST_BAR
    return net


def _joined(rows: list) -> Texts:
    """The windows of each row, one after the other, as its text."""
    parts = [
        b"".join(r.windows[SPAN * i : SPAN * i + n] for i, n in enumerate(r.sizes)) for r in rows
    ]
    ends = np.cumsum([0, *map(len, parts)])
    return Texts(np.frombuffer(b"".join(parts), np.uint8), ends)


def identify_languages(
    docs: DataFrame, net: ByteNetwork, keep: list[str], text: str = "text", prefix: str = ""
) -> DataFrame:
    """Columns ``keep`` of every row, with ``lang_pred`` and ``score`` after ``prefix``."""
    shared = docs.sparkSession.sparkContext.broadcast(net)  # a few thousand numbers

    def compute(part, texts):
        names = shared.value.languages
        pooled = shared.value.pooled(texts)
        best = pooled[:, : len(names)].argmax(1)
        known = np.array(part.column("_has_letter").to_pylist(), bool)
        known &= pooled[:, len(names) :].sum(1) <= shared.value.bar
        return [
            [names[b] if ok else UNDETERMINED for b, ok in zip(best, known, strict=True)],
            np.where(known, np.clip(pooled[np.arange(len(best)), best], 0, 1), 0.0),
        ]

    letter = F.coalesce(F.col(f"`{text}`").rlike(r"\p{L}"), F.lit(False))
    made = over_texts(
        docs.withColumn("_has_letter", letter),
        [*keep, "_has_letter"],
        f"{prefix}lang_pred string, {prefix}score double",
        compute,
        text,
    )
    return made.drop("_has_letter")


def language_spans(
    docs: DataFrame, net: ByteNetwork, keep: list[str], text: str = "text"
) -> DataFrame:
    """Columns ``keep`` of every row, and its runs of bytes of one label."""
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def compute(_, texts):
        labels = shared.value.labels(texts)
        edge = np.ones(len(labels) + 1, bool)
        edge[1:-1] = labels[1:] != labels[:-1]
        edge[texts.offsets] = True
        cuts = np.flatnonzero(edge)
        starts, ends = cuts[:-1], cuts[1:]
        of = texts.owner(starts)
        at = np.searchsorted(of, np.arange(1, len(texts)))
        base = texts.offsets[of]
        names = np.array([*shared.value.languages, UNDETERMINED], object)[labels[starts]]
        return [
            [x.tolist() for x in np.split(starts - base, at)],
            [x.tolist() for x in np.split(ends - base, at)],
            [x.tolist() for x in np.split(names, at)],
        ]

    new = "starts array<bigint>, ends array<bigint>, langs array<string>"
    return over_texts(docs, keep, new, compute, text)
