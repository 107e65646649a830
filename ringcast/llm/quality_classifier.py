"""Quality classifier: a factorisation machine over hashed words, structure and metadata.

Features of a text, each in a field of its own index range:

* its distinct words, hashed to ``2 ** WORD_BITS`` indices, of value 1 / sqrt(number);
* structure statistics (case, symbols, repetition, lines, lengths), each as the one bin
  of ``BINS`` it falls into, of value 1;
* metadata: the bin of the recorded number of characters, and of how far it is from the
  text's own; null metadata has a bin of its own.

The score is the logistic function of ``w0 + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j``;
the pairs cost linear time, as half of ``(sum v_i x_i)^2 - sum (v_i x_i)^2`` per factor.

The model is fitted on at most ``per_class`` labelled rows of either label, taken by the
hash of their key; whole texts are read.  Rows with an unknown or contradictory label
teach nothing.  Null and empty texts have no word and get the score of their structure
bins.  Every row is scored alone, so repeated rows get equal scores; an empty table gives
an empty result, and a learning set without both labels raises ValueError.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringcast.llm.quality_rules import repeated_words, repeats
from ringcast.llm.tables import sample_per_class
from ringcast.llm.texts import Texts, over_texts

WORD_BITS = 16
BINS = 12
STATISTICS = (
    "words", "letters per word", "upper case", "digits", "symbols", "exclamation marks",
    "pipes", "punctuation", "beyond ascii", "repeated runs", "word after itself",
    "distinct words", "words per line", "repeated lines",
)
METADATA = ("recorded length", "length differs")
SIZE = (1 << WORD_BITS) + BINS * (len(STATISTICS) + len(METADATA))
FACTORS = 8
PER_CLASS = 1500


def _marks(characters: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(characters)] = True
    return out


_UPPER = _marks(bytes(range(65, 91)))
_DIGIT = _marks(bytes(range(48, 58)))
_SYMBOL = _marks(b"#*$%&<>=+~^@\\_{}[]")
_POINT = _marks(b".,;:?()'\"-")


def structure(texts: Texts) -> np.ndarray:
    """STATISTICS of each text, from 0 to 1; an empty text has zeros."""
    owner = texts.words[2]
    n = len(texts)
    words = np.bincount(owner, minlength=n)
    most = np.maximum(words, 1)
    chars = texts.per_text(texts.points & ~texts.space)
    per_char = np.maximum(chars, 1)

    def share(table):
        return texts.per_text(table[texts.data]) / per_char

    again = np.zeros(len(owner), bool)
    again[1:] = (texts.word_hashes[1:] == texts.word_hashes[:-1]) & (owner[1:] == owner[:-1])
    old = repeats(texts.word_hashes, owner)[1]
    begins, ends, of = texts.lines
    filled = texts.per_span(~texts.space, begins, ends) > 0
    lines = np.maximum(np.bincount(of[filled], minlength=n), 1)
    same = repeats(texts.hashes(begins[filled], ends[filled]), of[filled])[1]
    columns = [
        np.log1p(words) / 12,
        chars / most / 24,
        np.sqrt(share(_UPPER)),
        np.sqrt(share(_DIGIT)),
        np.sqrt(share(_SYMBOL)),
        np.sqrt(share(_marks(b"!"))),
        np.sqrt(share(_marks(b"|"))),
        np.sqrt(share(_POINT)),
        texts.per_text((texts.data >= 0xC0)) / per_char,
        np.sqrt(repeated_words(texts) / most),
        np.sqrt(np.bincount(owner[again], minlength=n) / most),
        np.bincount(owner[~old], minlength=n) / most,
        np.log1p(most / lines) / 12,
        np.sqrt(np.bincount(of[filled][same], minlength=n) / lines),
    ]
    return np.clip(np.stack(columns, 1), 0, 1)


def features(texts: Texts, recorded: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Index, value and text of each feature, by text; ``recorded`` is NaN where unknown."""
    n = len(texts)
    owner = texts.words[2]
    buckets = (texts.word_hashes >> np.uint64(64 - WORD_BITS)).astype(np.int64)
    pairs = np.unique((owner << WORD_BITS) | buckets)
    of, index = pairs >> WORD_BITS, pairs & ((1 << WORD_BITS) - 1)
    value = 1 / np.sqrt(np.bincount(of, minlength=n)[of])

    stats = structure(texts)
    chars = texts.per_text(texts.points)
    known = np.isfinite(recorded)
    length = np.where(known, np.log1p(np.maximum(np.nan_to_num(recorded), 0)) / 14, 0)
    differs = np.where(known, np.abs(np.nan_to_num(recorded) - chars) / np.maximum(chars, 1), 0)
    stats = np.concatenate([stats, np.clip(np.stack([length, differs], 1), 0, 1)], 1)
    # bin 0 is for exact zeros; the last one of a metadata field for nulls
    bins = np.where(stats > 0, 1 + np.minimum((stats * (BINS - 2)).astype(np.int64), BINS - 3), 0)
    bins[~known, -len(METADATA) :] = BINS - 1
    fields = (1 << WORD_BITS) + BINS * np.arange(stats.shape[1])
    of = np.concatenate([of, np.repeat(np.arange(n), stats.shape[1])])
    index = np.concatenate([index, (bins + fields).ravel()])
    value = np.concatenate([value, np.ones(bins.size)])
    order = np.argsort(of, kind="stable")
    return index[order], value[order].astype(np.float32), of[order]


@dataclass
class FactorisationMachine:
    bias: float
    weights: np.ndarray  # SIZE
    factors: np.ndarray  # SIZE x FACTORS

    def sums(self, index, value, of, n):
        """Per text the linear part, and the sum of v x and of (v x)^2 for each factor."""
        at = np.searchsorted(of, np.arange(n))
        vx = self.factors[index] * value[:, None]
        linear = np.add.reduceat(self.weights[index] * value, at)
        return linear, np.add.reduceat(vx, at), np.add.reduceat(vx * vx, at)

    def margin(self, index, value, of, n) -> np.ndarray:
        # every text has its structure bins, so no segment is empty
        linear, first, second = self.sums(index, value, of, n)
        return self.bias + linear + 0.5 * (first**2 - second).sum(1)

    def scores(self, index, value, of, n) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(index, value, of, n), -30, 30)))

    @classmethod
    def fit(
        cls, rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray,
        epochs: int = 8, rate: float = 0.1, ridge: float = 1e-4, batch: int = 32, seed: int = 7,
    ) -> FactorisationMachine:
        """Stochastic gradient descent on the logistic loss, with AdaGrad steps."""
        random = np.random.default_rng(seed)
        share = labels.mean()
        model = cls(
            float(np.log(share / (1 - share))),
            np.zeros(SIZE, np.float32),
            random.normal(0, 0.01, (SIZE, FACTORS)).astype(np.float32),
        )
        seen_w = np.full(SIZE, 1e-6, np.float32)
        seen_v = np.full((SIZE, FACTORS), 1e-6, np.float32)
        for _ in range(epochs):
            order = random.permutation(len(rows))
            for some in np.array_split(order, max(1, len(order) // batch)):
                index = np.concatenate([rows[i][0] for i in some])
                value = np.concatenate([rows[i][1] for i in some])
                of = np.repeat(np.arange(len(some)), [len(rows[i][0]) for i in some])
                _, first, _ = model.sums(index, value, of, len(some))
                wrong = model.scores(index, value, of, len(some)) - labels[some]
                slope = (wrong[of] * value).astype(np.float32)
                uniq, back = np.unique(index, return_inverse=True)
                grad_w = np.bincount(back, slope, len(uniq)) / len(some)
                grad_w += ridge * model.weights[uniq]
                each = slope[:, None] * (first[of] - model.factors[index] * value[:, None])
                by = np.argsort(back, kind="stable")
                grad_v = np.add.reduceat(each[by], np.searchsorted(back[by], np.arange(len(uniq))))
                grad_v = grad_v / len(some) + ridge * model.factors[uniq]
                seen_w[uniq] += grad_w**2
                seen_v[uniq] += grad_v**2
                model.weights[uniq] -= rate * grad_w / np.sqrt(seen_w[uniq])
                model.factors[uniq] -= rate * grad_v / np.sqrt(seen_v[uniq])
                model.bias -= rate * float(wrong.mean())
        return model


def _recorded(part: pa.RecordBatch, column: str | None) -> np.ndarray:
    if column is None:
        return np.full(len(part), np.nan)
    return part.column(column).cast(pa.float64()).to_numpy(zero_copy_only=False)


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    key: str = "doc_id",
    text: str = "text",
    n_chars: str | None = "n_chars",
    per_class: int = PER_CLASS,
) -> FactorisationMachine:
    """Fits on ``labels`` (key and label) that have a row in ``docs``.

    Features are made where the texts are; those of at most 2 * per_class texts reach
    the driver.
    """
    there = labels.join(docs.select(key).distinct(), key)
    chosen = sample_per_class(there, key, label, per_class, [0, 1])
    read = [key, text] + [n_chars] * (n_chars is not None)
    some = docs.select(*read).join(F.broadcast(chosen), key)
    # a key may have two texts; the least teaches
    some = some.groupBy(key, "label").agg(F.min(F.struct(*read[1:])).alias("_least"))
    some = some.select(key, "label", "_least.*")

    def compute(part, texts):
        index, value, of = features(texts, _recorded(part, n_chars))
        at = np.searchsorted(of, np.arange(1, len(texts)))
        return [
            pa.array([x.tobytes() for x in np.split(index.astype(np.int32), at)], pa.binary()),
            pa.array([x.tobytes() for x in np.split(value, at)], pa.binary()),
        ]

    keep = [key, "label"] + [n_chars] * (n_chars is not None)
    rows = over_texts(some, keep, "feature binary, amount binary", compute, text)
    got = rows.select(key, "label", "feature", "amount").collect()
    got.sort(key=lambda r: r[0])
    truth = np.array([r.label for r in got], np.float64)
    if not (truth == 0).any() or not (truth == 1).any():
        raise ValueError("learning rows of both labels are needed")
    pairs = [
        (np.frombuffer(r.feature, np.int32), np.frombuffer(r.amount, np.float32)) for r in got
    ]
    # the sample is balanced; two classes of equal size keep the threshold at 0.5
    return FactorisationMachine.fit(pairs, truth)


def score_quality(
    docs: DataFrame,
    model: FactorisationMachine,
    keep: list[str],
    text: str = "text",
    n_chars: str | None = "n_chars",
    prefix: str = "",
) -> DataFrame:
    """Columns ``keep`` of every row, with ``score`` and ``predicted`` after ``prefix``."""
    context = docs.sparkSession.sparkContext
    shared = context.broadcast(model)  # SIZE * (FACTORS + 1) numbers, whatever the data

    def compute(part, texts):
        index, value, of = features(texts, _recorded(part, n_chars))
        score = shared.value.scores(index, value, of, len(texts)).astype(np.float64)
        return [score, (score >= 0.5).astype(np.int32)]

    extra = [n_chars] if n_chars is not None and n_chars not in keep else []
    new = f"{prefix}score double, {prefix}predicted int"
    made = over_texts(docs, keep + extra, new, compute, text)
    return made.drop(*extra)
