"""Benchmark passages in documents, by a prefix-filtered set join.

Words are runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after A-Z is lower-cased.  Every
``window`` consecutive words of an item are a window; an item with fewer words, but not
none, is one window.  A document word is hit if it lies in an occurrence of a window.

A window is a set of ``shingle``-word tokens (a shorter window has one token, all its
words), ordered by rarity: the number of occurrences in all documents, then the hash.
Containment has to be whole, so the necessary prefix of a window is its rarest token:

1. one pass over the documents counts the tokens that windows have (a bitmap of fixed
   size leaves the others out before anything is shuffled);
2. each window keeps its rarest token; one that occurs nowhere rules its window out;
3. a second pass gives the occurrences of those tokens, with the words around them;
4. both are joined by token; the token's place in the window and the document's number of
   words bound where the window can lie, and its words are compared one by one, as 64-bit
   hashes.

The join is by equality of rare tokens and has no broadcast hint.  Documents move as one
short row each; only those with a prefix token are joined.

Null and empty texts have no words: nothing is hit, and the digest is that of an empty
string.  Every row gets one result, repeated rows and null keys included.  Items alike in
text all count; items without id hit words but are not named.  Without items nothing is
hit; without documents the result is empty.  Columns other than the key and the text are
not read, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringcast.llm.texts import Texts, mix, over_texts
from ringcast.session import stage

WINDOW, SHINGLE = 10, 3
CELLS = 1 << 22  # of the bitmap that a pass over the documents is given: 512 KB
KEPT_COUNTS = 1 << 18  # tokens counted in a task before they are given out

_U = np.uint64
#: Lower case of A-Z; everything that is no part of a word becomes a space.
_TO_WORDS = np.array(
    [b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
     for b in range(256)], np.uint8,
)


def word_texts(texts: Texts) -> Texts:
    return Texts(_TO_WORDS[texts.data], texts.offsets)


def token_hashes(texts: Texts, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first word (its number among all words) of each run of k words of a text."""
    owner, hashes = texts.words[2], texts.word_hashes
    n = max(len(hashes) - k + 1, 0)
    at = np.flatnonzero(owner[:n] == owner[k - 1 :]) if n else np.zeros(0, np.int64)
    value = np.full(len(at), k, _U)
    for j in range(k):
        value = value * _U(0x9E3779B97F4A7C15) + hashes[at + j]
    return mix(value), at


def _lists(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """A list array of slices of ``values``."""
    sizes = ends - starts
    total = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=total[1:])
    at = np.arange(total[-1]) - np.repeat(total[:-1] - starts, sizes)
    return pa.ListArray.from_arrays(total.astype(np.int32), pa.array(values[at]))


def item_windows(items: DataFrame, key: str, text: str, window: int, shingle: int) -> DataFrame:
    """Column ``key`` and every window of the item as hashes: its words, and its tokens."""

    def compute(_, texts):
        texts = word_texts(texts)
        hashes, counts = texts.word_hashes, np.bincount(texts.words[2], minlength=len(texts))
        ends = np.cumsum(counts)
        words, tokens = [], []
        for end, count in zip(ends.tolist(), counts.tolist(), strict=True):
            own = hashes[end - count : end]
            size = min(window, count)
            spans = [own[i : i + size] for i in range(count - size + 1)] if count else []
            words.append([s.view(np.int64).tolist() for s in spans])
            tokens.append([_tokens(s, min(shingle, size)) for s in spans])
        return [words, tokens]

    made = over_texts(
        items, [key], "words array<array<bigint>>, tokens array<array<bigint>>", compute, text
    )
    each = F.explode(F.arrays_zip("words", "tokens")).alias("w")
    return made.select(F.col(f"`{key}`").alias("item"), each).select("item", "w.*")


def _tokens(words: np.ndarray, k: int) -> list[int]:
    """The hashes that ``token_hashes`` gives the runs of k words."""
    runs = [words[i : i + k] for i in range(len(words) - k + 1)]
    folded = [(_fold_from(k, r)) for r in runs]
    return mix(np.array(folded, _U)).view(np.int64).tolist()


def _fold_from(k: int, run: np.ndarray) -> int:
    value = k
    for h in run.tolist():
        value = (value * 0x9E3779B97F4A7C15 + h) % (1 << 64)
    return value


def _bitmap(tokens: DataFrame) -> np.ndarray:
    """Which cells have a token; at most ``CELLS`` numbers reach the driver."""
    cells = tokens.select(F.pmod("token", F.lit(CELLS)).alias("cell")).distinct().toArrow()
    marked = np.zeros(CELLS, bool)
    marked[cells.column("cell").to_numpy()] = True
    return np.packbits(marked)


def _found(texts: Texts, sizes: list[int], bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens in marked cells, and the number of their first word among all words."""
    tokens, places = [], []
    for k in sizes:
        hashes, at = token_hashes(texts, k)
        cell = (hashes & _U(CELLS - 1)).astype(np.int64)
        good = (bits[cell >> 3] >> (7 - (cell & 7)).astype(np.uint8)) & 1 == 1
        tokens.append(hashes[good].view(np.int64))
        places.append(at[good])
    return np.concatenate(tokens), np.concatenate(places)


def token_counts(docs: DataFrame, sizes: list[int], bits, text: str) -> DataFrame:
    """Occurrences in all documents of the tokens in marked cells: ``token``, ``n``."""

    def run(batches):
        counted: dict[int, int] = {}

        def rows():
            out = pa.RecordBatch.from_pydict(
                {"token": pa.array(counted.keys(), pa.int64()),
                 "n": pa.array(counted.values(), pa.int64())}
            )
            counted.clear()
            return out

        for batch in batches:
            pairs = zip(
                batch.column("token").to_pylist(), batch.column("times").to_pylist(), strict=True
            )
            for tokens, times in pairs:
                for t, n in zip(tokens, times, strict=True):
                    counted[t] = counted.get(t, 0) + n
            if len(counted) > KEPT_COUNTS:
                yield rows()
        yield rows()

    def compute(_, texts):
        texts = word_texts(texts)
        found, n = np.unique(_found(texts, sizes, bits.value)[0], return_counts=True)
        # the counts of the whole slice stand in the row of its first text
        ends = np.full(len(texts), len(found))
        starts = np.where(np.arange(len(texts)) == 0, 0, ends)
        return [_lists(found, starts, ends), _lists(n, starts, ends)]

    made = over_texts(docs, [], "token array<bigint>, times array<bigint>", compute, text)
    counts = made.mapInArrow(run, "token long, n long")
    return counts.groupBy("token").agg(F.sum("n").alias("n"))


def prefix_places(
    docs: DataFrame, keep: list[str], sizes: list[int], bits, text: str, window: int
) -> DataFrame:
    """Columns ``keep``, ``n_words``, and where tokens in marked cells begin.

    ``around`` holds the word hashes from ``window - 1`` words before the place on, to
    ``window`` words behind it, as far as the document has them.
    """

    def compute(_, texts):
        texts = word_texts(texts)
        counts = np.bincount(texts.words[2], minlength=len(texts))
        begins = np.cumsum(counts) - counts
        tokens, at = _found(texts, sizes, bits.value)
        owner = texts.words[2][at]
        order = np.lexsort((at, owner))
        tokens, at, owner = tokens[order], at[order], owner[order]
        first = np.maximum(at - window + 1, begins[owner])
        last = np.minimum(at + window, begins[owner] + counts[owner])
        around = _lists(texts.word_hashes.view(np.int64), first, last)
        ends = np.cumsum(np.bincount(owner, minlength=len(texts)))
        rows = pa.array(np.concatenate([[0], ends]).astype(np.int32))
        return [
            counts,
            pa.ListArray.from_arrays(rows, pa.array(tokens)),
            pa.ListArray.from_arrays(rows, pa.array(at - begins[owner])),
            pa.ListArray.from_arrays(rows, around),
        ]

    new = "n_words bigint, token array<bigint>, at array<bigint>, around array<array<bigint>>"
    return over_texts(docs, keep, new, compute, text)


def _covered(spans) -> F.Column:
    """Words in at least one of the spans (start, n), sorted by start."""
    none = F.struct(F.lit(0).cast("long").alias("to"), F.lit(0).cast("long").alias("words"))

    def add(state, span):
        end = F.greatest(state["to"], span["start"] + span["n"])
        return F.struct(
            end.alias("to"),
            (state["words"] + end - F.least(F.greatest(state["to"], span["start"]), end))
            .alias("words"),
        )

    return F.aggregate(F.array_sort(spans), none, add)["words"]


def find_items(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    item_key: str = "item_id",
    text: str = "text",
    window: int = WINDOW,
    shingle: int = SHINGLE,
) -> DataFrame:
    """For every document its words, those hit, and the items with occurring windows.

    Columns: ``key``, ``n_words``, ``n_hit``, ``spans`` (start and number of words of each
    occurrence, sorted), ``items`` (ids as strings, sorted).
    """
    spark = docs.sparkSession
    raw = stage(item_windows(items, item_key, text, window, shingle), "item-windows")
    windows = raw.select("words", "tokens").distinct()
    tokens = windows.select("words", F.posexplode("tokens").alias("offset", "token"))
    lengths = raw.select(F.least(F.size("words"), F.lit(shingle)).alias("k")).distinct()
    sizes = sorted(r.k for r in lengths.collect()) or [shingle]  # numbers up to ``shingle``

    bits = spark.sparkContext.broadcast(_bitmap(tokens))
    counts = token_counts(docs, sizes, bits, text)
    rarest = F.min(F.struct("n", "token", "offset")).alias("least")
    prefixes = tokens.join(counts, "token").groupBy("words").agg(rarest, F.count("*").alias("c"))
    # a token that no document has rules its window out
    whole = F.size("words") - F.least(F.size("words"), F.lit(shingle)) + 1
    prefixes = prefixes.where(F.col("c") == whole).select(
        "words", F.col("least.token").alias("token"), F.col("least.offset").alias("offset")
    )
    prefixes = stage(prefixes, "prefixes")

    bits = spark.sparkContext.broadcast(_bitmap(prefixes))
    places = prefix_places(docs, [key], sizes, bits, text, window)
    places = stage(places.withColumn("_row", F.monotonically_increasing_id()), "prefix-places")
    each = F.explode(F.arrays_zip("token", "at", "around")).alias("p")
    candidates = places.select("_row", "n_words", each).select("_row", "n_words", "p.*")
    n = F.size("words")
    before = F.least(F.col("at"), F.lit(window - 1))
    verified = (
        candidates.join(prefixes, "token")
        .where((F.col("offset") <= F.col("at")) & (F.col("at") - F.col("offset") + n <= F.col("n_words")))
        .where(F.slice("around", (before - F.col("offset") + 1).cast("int"), n) == F.col("words"))
        .select("_row", (F.col("at") - F.col("offset")).alias("start"), n.cast("long").alias("n"), "words")
    )
    verified = stage(verified, "verified-windows")
    spans = verified.groupBy("_row").agg(
        F.array_sort(F.collect_set(F.struct("start", "n"))).alias("spans")
    )
    named = raw.select("words", F.col("item").cast("string").alias("item")).distinct()
    ids = (
        verified.select("_row", "words").distinct().join(named, "words")
        .groupBy("_row").agg(F.array_sort(F.collect_set("item")).alias("items"))
    )
    none = F.array().cast("array<struct<start:bigint,n:bigint>>")
    return (
        places.select("_row", f"`{key}`", "n_words")
        .join(spans, "_row", "left")
        .join(ids, "_row", "left")
        .select(
            f"`{key}`",
            "n_words",
            F.coalesce(_covered(F.col("spans")), F.lit(0).cast("long")).alias("n_hit"),
            F.coalesce("spans", none).alias("spans"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        )
    )


def item_digests(docs: DataFrame, items: DataFrame, **named) -> DataFrame:
    """``find_items`` with the items counted and hashed."""
    found = find_items(docs, items, **named)
    passed = [c for c in found.columns if c not in ("spans", "items")]
    return found.select(
        *[f"`{c}`" for c in passed],
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
