"""Encoding and decoding with a merge-type (BPE) SentencePiece model file.

Greedy merging gives every prefix of a text one last token, and a sequence of tokens is
the encoding exactly when each two neighbours are compatible: encoding their joined
text gives back the two.  So for each prefix the table needs one entry: of the pieces
that end there, found by an automaton, the one compatible with the last token of the
prefix before it.  Following the entries from the end gives the ids backwards.

Two tokens are compatible unless a merge over their border comes before the merges that
made them; the test undoes those merges, latest first, and looks for such a pair.

Characters outside the vocabulary are given as their bytes.  No piece of the supported
models has white space after another character, so texts fall apart at white space, and
the ids of short runs are kept in a bounded cache.  Null texts count as empty, which
have no ids; every row is encoded alone and whole.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator

import ahocorasick
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringcast.llm.texts import Shelf, over_texts

SPACE = "▁"
UNKNOWN_SURFACE = " ⁇ "
CACHED_RUNS, CACHED_CHARS, CACHED_PAIRS = 200_000, 48, 200_000
# piece types of the public model format
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = range(1, 7)


def _fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of one serialised message."""
    at = 0

    def number():
        nonlocal at
        value = shift = 0
        while True:
            byte = raw[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(raw):
        tag = number()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, number()
            continue
        size = number() if kind == 2 else {1: 8, 5: 4}[kind]
        yield tag >> 3, raw[at : at + size]
        at += size


class PieceModel:
    """Vocabulary and merges of a model; ``encode`` and ``decode`` work on whole texts."""

    def __init__(self, raw: bytes):
        self.pieces: list[str] = []
        scores: list[float] = []
        self.types: list[int] = []
        trainer: dict = {}
        normal: dict = {}
        for field, value in _fields(raw):
            if field == 1:
                piece = dict(_fields(value))
                self.pieces.append(piece[1].decode())
                scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
                self.types.append(piece.get(3, NORMAL))
            elif field in (2, 3):
                (trainer if field == 2 else normal).update(_fields(value))
        if trainer.get(3, 1) != 2 or not trainer.get(35, 0):
            raise ValueError("only merge-type models with byte fallback are supported")
        if normal.get(2) or normal.get(4, 1):
            raise ValueError("only models that leave texts as they are are supported")
        if {USER_DEFINED, UNUSED} & set(self.types):
            raise ValueError("models with user-defined or unused pieces are not supported")
        self.dummy_prefix = bool(normal.get(3, 1))
        self.byte_ids = {
            int(p[3:5], 16): i for i, p in enumerate(self.pieces) if self.types[i] == BYTE
        }
        self.ids = {p: i for i, p in enumerate(self.pieces) if self.types[i] == NORMAL}
        rank = {s: r for r, s in enumerate(sorted(set(scores), reverse=True))}
        self.rank = [rank[s] for s in scores]
        self._split()
        self.sizes = [len(p) for p in self.pieces]
        self.plain = frozenset(self.ids.values())
        self.alphabet = frozenset(p for p in self.ids if len(p) == 1)
        known = "".join(map(re.escape, sorted(self.alphabet)))
        self.find_known = re.compile(f"[{known}]+|[^{known}]").findall
        self._pairs: dict[int, bool] = {}
        self._runs = _Runs(self)

    def _split(self) -> None:
        """For each reachable piece its last merge; an automaton over those pieces."""
        self.left: dict[int, int] = {}
        self.right: dict[int, int] = {}
        self.automaton = ahocorasick.Automaton()
        inner = False
        for piece, i in self.ids.items():
            inner |= SPACE in piece.lstrip(SPACE)
            if any(c not in self.ids for c in piece):
                raise ValueError(f"a character of piece {i} is not a piece")
            if len(piece) > 1:
                last = self._last_merge(piece)
                if last is None:
                    continue
                self.left[i], self.right[i] = self.ids[last[0]], self.ids[last[1]]
            self.automaton.add_word(piece, (i, len(piece)))
        self.automaton.make_automaton()
        chars = "".join(map(re.escape, (c for c in "\n\t" if c not in self.ids)))
        runs = f"{SPACE}*[^{SPACE}{chars}]+|{SPACE}+|[{chars}]" if chars else (
            f"{SPACE}*[^{SPACE}]+|{SPACE}+"
        )
        self.find_runs = re.compile("(?s).+" if inner else runs).findall

    def _last_merge(self, piece: str) -> tuple[str, str] | None:
        """Merges a piece's characters; None if they do not end as the piece."""
        parts = list(piece)
        while len(parts) > 1:
            best = min(
                ((self.rank[k], j) for j in range(len(parts) - 1)
                 if (k := self.ids.get(parts[j] + parts[j + 1])) is not None),
                default=None,
            )
            if best is None:
                return None
            j = best[1]
            if len(parts) == 2:
                return parts[0], parts[1]
            parts[j : j + 2] = [parts[j] + parts[j + 1]]
        return None

    def compatible(self, a: int, b: int) -> bool:
        """Whether neighbours ``a`` and ``b`` can stand in an encoding."""
        key = a * len(self.pieces) + b
        known = self._pairs.get(key)
        if known is None:
            if len(self._pairs) >= CACHED_PAIRS:
                self._pairs.clear()
            known = self._pairs[key] = self._test(a, b)
        return known

    def _test(self, a: int, b: int) -> bool:
        never = len(self.pieces)  # a rank after all merges
        pieces, ids, rank = self.pieces, self.ids, self.rank
        # ranks before which a merge over the border happens: of equal ranks the leftmost
        # goes first, so it loses against one in a, and wins against one in b
        before_a, before_b = never, never
        while True:
            over = ids.get(pieces[a] + pieces[b])
            if over is not None and rank[over] < before_a and rank[over] <= before_b:
                return False
            in_a = rank[a] if a in self.left else -1
            in_b = rank[b] if b in self.left else -1
            if in_a < 0 and in_b < 0:
                return True
            # undo the merge that came later; of equal ranks the one in b
            if in_a > in_b:
                before_a, a = min(before_a, in_a), self.right[a]
            else:
                before_b, b = min(before_b, in_b), self.left[b]

    def _known(self, run: str) -> list[int]:
        """Ids of a run of characters that are all in the vocabulary."""
        last = [-1] * (len(run) + 1)
        pairs, vocabulary = self._pairs, len(self.pieces)
        for end, (token, size) in self.automaton.iter(run):
            end += 1
            if last[end] >= 0:  # the one entry of this prefix is found
                continue
            if size == end:
                last[end] = token
                continue
            before = last[end - size]
            good = pairs.get(before * vocabulary + token)
            if good if good is not None else self.compatible(before, token):
                last[end] = token
        out, at, sizes = [], len(run), self.sizes
        while at:
            token = last[at]
            out.append(token)
            at -= sizes[token]
        out.reverse()
        return out

    def encode_run(self, run: str) -> list[int]:
        if self.alphabet.issuperset(run):
            return self._known(run)
        out: list[int] = []
        for part in self.find_known(run):
            if part[0] in self.alphabet:
                out += self._known(part)
            else:
                out += [self.byte_ids[x] for x in part.encode()]
        return out

    def runs(self, text: str) -> list[str]:
        if not text:
            return []
        return self.find_runs((SPACE if self.dummy_prefix else "") + text.replace(" ", SPACE))

    def encode(self, text: str) -> list[int]:
        return [i for run in self.runs(text) for i in self.encode_run(run)]

    def surface(self, ids: list[int]) -> str:
        """Text of ids with white space still escaped."""
        if self.plain.issuperset(ids):
            return "".join([self.pieces[i] for i in ids])
        out: list[str] = []
        raw = bytearray()
        for i in ids:
            kind = self.types[i]
            if kind == BYTE:
                raw.append(int(self.pieces[i][3:5], 16))
                continue
            if raw:
                out.append(_from_bytes(bytes(raw)))
                raw.clear()
            if kind == UNKNOWN:
                out.append(UNKNOWN_SURFACE)
            elif kind != CONTROL:
                out.append(self.pieces[i])
        if raw:
            out.append(_from_bytes(bytes(raw)))
        return "".join(out)

    def decode(self, ids: list[int]) -> str:
        ids = [i for i in ids if self.types[i] != CONTROL]
        prefixed = self.dummy_prefix and ids and self.pieces[ids[0]].startswith(SPACE)
        return self.surface(ids)[1 if prefixed else 0 :].replace(SPACE, " ")

    def digest(self, text: str) -> tuple[int, str, str]:
        """Number of ids, and the hashes of the ids and of what they decode to."""
        runs, known = self.runs(text), self._runs
        if len(known.odd) >= CACHED_RUNS:
            known.forget()
        ids = ",".join(map(known.__getitem__, runs))
        if known.odd.keys().isdisjoint(runs):
            decoded = text  # every run decodes to itself
        else:
            decoded = "".join([known.odd.get(r, r) for r in runs])
            if self.dummy_prefix:
                decoded = decoded[1:]
        decoded = decoded.replace(SPACE, " ")
        return (
            ids.count(",") + 1 if ids else 0,
            hashlib.sha256(ids.encode()).hexdigest(),
            hashlib.sha256(decoded.encode()).hexdigest(),
        )


class _Runs(dict):
    """Short runs to their ids, joined by commas; runs that decode to other text in ``odd``.

    A run holds whole characters, so bytes of a character never lie in two runs.  When half
    of the bounded size is full, its runs become the older half and the former older half is
    forgotten; a run met again moves back, so frequent runs stay.
    """

    def __init__(self, model: PieceModel):
        super().__init__()
        self.model = model
        self.older: dict[str, str] = {}
        self.odd: dict[str, str] = {}

    def forget(self) -> None:
        for runs in (self, self.older, self.odd):
            runs.clear()

    def __missing__(self, run: str) -> str:
        made = self.older.get(run)
        if made is None:
            ids = self.model.encode_run(run)
            made = ",".join(map(str, ids))
            surface = self.model.surface(ids)
            if surface != run:
                self.odd[run] = surface
        if len(run) <= CACHED_CHARS:
            if len(self) >= CACHED_RUNS // 2:
                self.older = dict(self)
                self.clear()
            self[run] = made
        return made


def _from_bytes(raw: bytes) -> str:
    """Decodes characters; every byte outside of one becomes a replacement character."""
    out, at = [], 0
    while at < len(raw):
        for size in (1, 2, 3, 4):
            try:
                out.append(raw[at : at + size].decode("utf-8"))
            except UnicodeDecodeError:
                continue
            at += size
            break
        else:
            out.append("�")
            at += 1
    return "".join(out)


_model = Shelf()


def model_of(raw: bytes) -> PieceModel:
    """The model of a file's content; a worker process builds it once."""
    return _model.get(hashlib.sha256(raw).digest(), lambda: PieceModel(raw))


def _shared(docs: DataFrame, model_file: str):
    with open(model_file, "rb") as file:  # a vocabulary, of fixed size
        return docs.sparkSession.sparkContext.broadcast(file.read())


def _strings(part, column: str) -> list[str]:
    return [x or "" for x in part.column(column).to_pylist()]


def encode_texts(
    docs: DataFrame, model_file: str, keep: list[str], text: str = "text", ids: str = "ids"
) -> DataFrame:
    """Columns ``keep`` of every row, and the ids of its whole text."""
    shared = _shared(docs, model_file)

    def compute(part, _):
        model = model_of(shared.value)
        return [[model.encode(x) for x in _strings(part, text)]]

    return over_texts(docs, keep, f"{ids} array<int>", compute, text)


def decode_ids(
    docs: DataFrame, model_file: str, keep: list[str], ids: str = "ids", text: str = "text"
) -> DataFrame:
    """Columns ``keep`` of every row, and the text of its ids; null ids give an empty text."""
    shared = _shared(docs, model_file)
    joined = docs.select(
        *[f"`{c}`" for c in keep if c not in (text, "_ids")],
        F.concat_ws(",", F.col(f"`{ids}`").cast("array<string>")).alias("_ids"),
    )

    def compute(part, _):
        model = model_of(shared.value)
        rows = [[int(i) for i in x.split(",")] if x else [] for x in _strings(part, "_ids")]
        return [[model.decode(x) for x in rows]]

    return over_texts(joined, [c for c in joined.columns if c != "_ids"],
                      f"{text} string", compute, "_ids")


def token_digests(
    docs: DataFrame, model_file: str, keep: list[str], text: str = "text"
) -> DataFrame:
    """Columns ``keep``, the number of ids, and hashes of the ids and their decoding."""
    shared = _shared(docs, model_file)

    def compute(part, _):
        model = model_of(shared.value)
        found = [model.digest(x) for x in _strings(part, text)]
        return [list(c) for c in zip(*found, strict=True)] or [[], [], []]

    return over_texts(
        docs, keep, "n_tokens bigint, ids_sha256 string, decoded_sha256 string", compute, text
    )
