"""Texts of an Arrow batch as flat numpy arrays: words, lines and their hashes.

A word is a run of characters other than ASCII white space, ``[^\\x20\\x09-\\x0D]+``.
Null texts count as empty.  Hashes have 64 bits and depend on the bytes alone, so
they agree between tasks and runs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

SLICE_BYTES = 500_000  # of text worked on at once; a longer text is a slice of its own

_U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2^64
_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 bits (splitmix64)."""
    x = x.astype(_U, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


_BYTE_VALUES = mix(np.arange(1, 257, dtype=_U) * _U(_BASE))


def _power(base: int, n: int) -> np.ndarray:
    known = _powers.get(base)
    if known is None or len(known) < n:
        factors = np.full(max(n, SLICE_BYTES + 1), base, _U)
        factors[0] = 1
        known = _powers[base] = np.cumprod(factors, dtype=_U)
    return known[:n]


@dataclass
class Texts:
    """Texts one after the other: text i is ``data[offsets[i]:offsets[i + 1]]``."""

    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    @classmethod
    def of(cls, column: pa.Array) -> Texts:
        column = column.cast(pa.large_string()).fill_null("")
        _, ends, raw = column.buffers()
        offsets = np.frombuffer(ends, np.int64)[column.offset : column.offset + len(column) + 1]
        data = np.frombuffer(raw, np.uint8) if raw else np.zeros(0, np.uint8)
        return cls(data[offsets[0] : offsets[-1]], offsets - offsets[0])

    @cached_property
    def space(self) -> np.ndarray:
        return _SPACE[self.data]

    @cached_property
    def _prefix(self) -> np.ndarray:
        """Polynomial hash of every prefix of ``data``."""
        out = np.zeros(len(self.data) + 1, _U)
        np.cumsum(_BYTE_VALUES[self.data] * _power(_BASE, len(self.data)), out=out[1:])
        return out

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A hash of each span of bytes; empty spans all get the same."""
        back = _power(pow(_BASE, -1, 1 << 64), len(self.data) + 1)[starts]
        return mix((self._prefix[ends] - self._prefix[starts]) * back + (ends - starts).astype(_U))

    @cached_property
    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and text of each word."""
        n = len(self.data)
        first = np.ones(n + 1, bool)
        first[1:n] = self.space[:-1] if n else False
        first[self.offsets] = True
        inside = ~self.space
        starts = np.flatnonzero(first[:n] & inside)
        last = np.ones(n + 1, bool)
        last[:n] = self.space
        last[self.offsets] = True
        ends = np.flatnonzero(last[1:] & inside) + 1 if n else starts
        return starts, ends, self.owner(starts)

    def owner(self, at: np.ndarray) -> np.ndarray:
        """The text that holds each position."""
        return np.searchsorted(self.offsets, at, side="right") - 1

    @cached_property
    def word_hashes(self) -> np.ndarray:
        return self.hashes(*self.words[:2])

    @cached_property
    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end (without the newline) and text of each line; an empty text has one."""
        breaks = np.flatnonzero(self.data == 10)
        starts = np.concatenate([self.offsets[:-1], breaks + 1])
        owner = np.concatenate([np.arange(len(self)), self.owner(breaks)])
        order = np.lexsort((starts, owner))
        starts, owner = starts[order], owner[order]
        ends = np.empty(len(starts), np.int64)
        ends[:-1] = starts[1:] - 1
        final = np.ones(len(starts), bool)
        final[:-1] = owner[1:] != owner[:-1]
        ends[final] = self.offsets[1:][owner[final]]
        return starts, ends, owner

    def per_span(self, marks: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Number of marked bytes in each span."""
        total = np.zeros(len(marks) + 1, np.int64)
        np.cumsum(marks, out=total[1:])
        return total[ends] - total[starts]

    def per_text(self, marks: np.ndarray) -> np.ndarray:
        return self.per_span(marks, self.offsets[:-1], self.offsets[1:])

    @cached_property
    def points(self) -> np.ndarray:
        """Marks the first byte of each code point."""
        return (self.data & 0xC0) != 0x80

    def shingles(self, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hash, text and first word of each run of k words.

        A text of one to k - 1 words has one shingle, of all its words.
        """
        owner, hashes = self.words[2], self.word_hashes
        counts = np.bincount(owner, minlength=len(self))
        n = max(len(hashes) - k + 1, 0)
        full = owner[:n] == owner[k - 1 :] if n else np.zeros(0, bool)
        at = np.flatnonzero(full)
        value = np.zeros(len(at), _U)
        for j in range(k):
            value = value * _U(_BASE) + hashes[at + j]
        short = np.flatnonzero((counts > 0) & (counts < k))
        if len(short):
            begins = np.cumsum(counts) - counts
            tails = np.array(
                [_fold(hashes[begins[i] : begins[i] + counts[i]]) for i in short], _U
            )
            at = np.concatenate([at, begins[short]])
            value = np.concatenate([value, tails])
        return mix(value), owner[at], at


def _fold(hashes: np.ndarray) -> int:
    value = 0
    for h in hashes.tolist():
        value = (value * _BASE + h) % (1 << 64)
    return value


class Shelf:
    """One thing that a worker process makes once, such as a model with its caches.

    The first task over texts that does not use it puts it away, so that a worker does not
    go on to other stages with what only earlier ones needed.
    """

    _all: list[Shelf] = []

    def __init__(self):
        self.key = self.value = None
        self.used = False
        Shelf._all.append(self)

    def get(self, key, make: Callable):
        """What was made for ``key``, or made now."""
        self.used = True
        if self.value is None or self.key != key:
            self.key = self.value = None  # before the next is made
            self.key, self.value = key, make()
        return self.value


def end_of_task() -> None:
    """Puts away what this task did not use, and gives freed memory back: a worker goes on
    to other stages, and would hold both."""
    for shelf in Shelf._all:
        if not shelf.used:
            shelf.key = shelf.value = None
        shelf.used = False
    pa.default_memory_pool().release_unused()


def slices(
    batch: pa.RecordBatch, text: str, together: int | None = None
) -> Iterator[pa.RecordBatch]:
    """Runs of rows with a bounded number of bytes of text, one row at least."""
    together = together or SLICE_BYTES
    offsets = Texts.of(batch.column(text)).offsets
    at = 0
    while at < len(batch):
        end = int(np.searchsorted(offsets, offsets[at] + together, side="right")) - 1
        end = max(at + 1, end)
        yield batch.slice(at, end - at)
        at = end


def over_texts(
    docs: DataFrame,
    keep: list[str],
    new: str,
    compute: Callable[[pa.RecordBatch, Texts], list],
    text: str = "text",
    together: int | None = None,
) -> DataFrame:
    """Columns ``keep`` of every row, and columns ``new`` (a DDL) computed from its text.

    ``compute`` gets some rows and their texts, and returns a list of arrays, one for
    each new column; ``together`` bounds the bytes of text in them.  A kept column with the name of a new one gives way to it; other
    columns of ``docs`` are not read, whatever their names.
    """
    importable(docs.sparkSession)
    added = T.StructType.fromDDL(new)
    made = {f.name for f in added}
    passed = [c for c in keep if c not in made]
    read = docs.select(*[f"`{c}`" for c in dict.fromkeys([*passed, text])])
    schema = T.StructType([*(read.schema[c] for c in passed), *added])
    names = schema.names
    kinds = {f.name: _ARROW[f.dataType.simpleString()] for f in added}

    def run(batches):
        for batch in batches:
            for part in slices(batch, text, together):
                values = compute(part, Texts.of(part.column(text)))
                arrays = [part.column(c) for c in passed]
                arrays += [
                    v if isinstance(v, pa.Array) else pa.array(v, kinds[f])
                    for f, v in zip(kinds, values, strict=True)
                ]
                yield pa.RecordBatch.from_arrays(arrays, names)
        end_of_task()

    return read.mapInArrow(run, schema)


_ARROW = {
    "bigint": pa.int64(),
    "int": pa.int32(),
    "double": pa.float64(),
    "boolean": pa.bool_(),
    "string": pa.string(),
    "binary": pa.binary(),
    "array<bigint>": pa.list_(pa.int64()),
    "array<array<bigint>>": pa.list_(pa.list_(pa.int64())),
    "array<int>": pa.list_(pa.int32()),
    "array<string>": pa.list_(pa.string()),
}


def importable(spark: SparkSession) -> None:
    """Let Python workers on this machine import the package; a cluster installs it."""
    context = spark.sparkContext
    if context.master.startswith("local"):
        context.environment["PYTHONPATH"] = str(Path(__file__).resolve().parents[2])
