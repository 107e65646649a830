"""Alignment of two tokenisations of the same bytes, and how ids of both meet corpus-wide.

Tokenizer A is a byte-level BPE file that gets a space and the text, B a merge-type piece
file that adds that space itself.  The byte offsets where tokens of both end cut the
tokens into groups.  Most groups are one token against one, so the two arrays of ends
are equal over long stretches once their indices are shifted: ``align`` probes slices of
doubling length at the current shift, finds the first difference in the slice that
differs, and resolves the irregular group there token by token, which gives the next shift.

A link is a pair of tokens whose byte ranges overlap.  Links of an id pair are counted
over all documents; tasks give sorted id pairs with their counts, summed before and after
the shuffle.  The counts then come back to the documents in blocks of at most about
``PAIRS`` id pairs: a block is broadcast, and each document's pairs, which were written
once, are looked up in it.  One block holds what usual corpora have; more blocks mean
more passes over the written pairs, whose sums are added.

Texts longer than ``PART`` characters are worked on in parts, cut where white space that
both tokenizers split at begins; a longer text without any such place is one part.

Null and empty texts, and texts whose tokens do not spell a space and the text (those
with U+2581, which B takes for a space), have no tokens.  Every row is aligned alone, and
counts in the sums, repeated rows and null keys included.  Columns other than those kept
and the text are not read.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ringcast.llm.pieces import BYTE, SPACE, model_of
from ringcast.llm.texts import importable, over_texts
from ringcast.session import stage

PART = 1_000_000  # characters worked on at once
PAIRS = 4_000_000  # id pairs broadcast at once, 17 bytes each
KEPT_PAIRS = 1_000_000  # id pairs summed in a task before they are given out
FIRST_PROBE = 16

_CUT = re.compile(r"(?<=\S)(?=[ \n\t])")
#: Characters outside Latin and common punctuation, where Unicode tables may differ.
_OTHER_SCRIPT = re.compile("[^\x00-ɏ‐-‧€]").search


def _byte_alphabet() -> dict[str, int]:
    """Characters that stand for bytes in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteLevel:
    """Ids and token lengths of a byte-level BPE file."""

    def __init__(self, raw: bytes, pattern: str):
        model = json.loads(raw)["model"]
        self.slow = Tokenizer.from_str(raw.decode())
        self.slow.encode_special_tokens = True
        alphabet = _byte_alphabet()
        vocabulary = {bytes(alphabet[c] for c in t): i for t, i in model["vocab"].items()}
        self.sizes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():
            self.sizes[i] = len(token)
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        in_order = all(
            model["vocab"][a + b] == 256 + i for i, (a, b) in enumerate(merges)
        ) and len(vocabulary) == 256 + len(merges)
        self.fast = in_order and tiktoken.Encoding(
            "a", pat_str=pattern, mergeable_ranks=vocabulary, special_tokens={}
        )

    def encode(self, part: str) -> list[int]:
        if self.fast and not _OTHER_SCRIPT(part):
            return self.fast.encode_ordinary(part)
        return self.slow.encode(part, add_special_tokens=False).ids


class Pieces:
    """Ids and token lengths of a piece file; ``encode`` takes parts that begin with white
    space, the first of them the added one.

    Greedy merging by score is byte-pair merging by rank, if the bytes of each known
    character are merged before anything else.  What is left of an unknown character
    becomes its bytes.  Parts with several spaces in a row, whose pieces have equal scores,
    are encoded by the file's own library, and all parts if other scores are equal.
    """

    def __init__(self, raw: bytes):
        model = model_of(raw)
        if {" ", "\n", "\t"} & model.alphabet or any(SPACE in p.lstrip(SPACE) for p in model.ids):
            raise ValueError("only models whose pieces end before white space are supported")
        self.library = sentencepiece.SentencePieceProcessor(model_proto=raw)
        self.space = model.ids[SPACE]
        self.sizes = np.array(
            [1 if model.types[i] == BYTE else len(p.replace(SPACE, " ").encode())
             for i, p in enumerate(model.pieces)], np.int64,
        )
        merged = sorted((i for p, i in model.ids.items() if len(p) > 1), key=model.rank.__getitem__)
        times = Counter(model.rank[i] for i in merged)
        alike = {i for i in merged if times[model.rank[i]] > 1}
        blank = all(not model.pieces[i].strip(SPACE) for i in alike)
        self.fast = blank and self._by_rank(model, [i for i in merged if i not in alike])

    def _by_rank(self, model, merged: list[int]) -> tiktoken.Encoding:
        ranks = {bytes([b]): b for b in range(256)}
        of_rank = {b: [model.byte_ids[b]] for b in range(256)}
        for char in sorted(model.alphabet):
            spelled = char.replace(SPACE, " ").encode()
            for n in range(2, len(spelled) + 1):
                rank = ranks.setdefault(spelled[:n], len(ranks))
                of_rank.setdefault(rank, [model.byte_ids[b] for b in spelled[:n]])
            of_rank[ranks[spelled]] = [model.ids[char]]
        for i in merged:
            rank = ranks[model.pieces[i].replace(SPACE, " ").encode()] = len(ranks)
            of_rank[rank] = [i]
        self.one = np.array([of_rank[r][0] if len(of_rank[r]) == 1 else -1 for r in range(len(ranks))])
        self.of_rank = of_rank
        return tiktoken.Encoding("b", pat_str=" *[^ ]+| +", mergeable_ranks=ranks, special_tokens={})

    def encode(self, part: str) -> np.ndarray:
        """Ids of a part, which must not hold U+2581."""
        if self.fast and "  " not in part:
            ranks = self.fast.encode_ordinary(part)
            ids = self.one[ranks]
            if len(ids) and ids.min() < 0:  # the beginning of a known character, in another
                ids = np.array([i for r in ranks for i in self.of_rank[r]], np.int64)
            return ids
        bare = part[1:] if part[0] == " " else part  # the library adds a space of its own
        if not bare:
            return np.array([self.space])
        ids = self.library.encode(bare)
        return np.array(ids if len(bare) < len(part) else ids[1:], np.int64)


def align(ends_a: np.ndarray, ends_b: np.ndarray) -> list[tuple[int, int, int, int]]:
    """Groups that are not one token against one: first and behind the last of A, of B.

    Both arrays (int32) rise and end alike.  All other groups are one-to-one.  Slices are
    compared as bytes, four to an end.
    """
    raw_a, raw_b = ends_a.tobytes(), ends_b.tobytes()
    at_a, at_b = memoryview(raw_a).cast("i"), memoryview(raw_b).cast("i")
    i = j = 0  # byte positions of the tokens behind the last cut
    n = len(raw_a)
    irregular = []
    while i < n:
        step = 4 * FIRST_PROBE
        while (probe := raw_a[i : i + step]) == (other := raw_b[j : j + step]):
            i += step
            j += step
            if i >= n:
                return irregular
            step *= 2
        differs = int.from_bytes(probe, "little") ^ int.from_bytes(other, "little")
        same = ((differs & -differs).bit_length() - 1) >> 5  # the first 32 bits that differ
        first_a, first_b = k, m = (i >> 2) + same, (j >> 2) + same
        a, b = at_a[k], at_b[m]
        while a != b:
            if a < b:
                k += 1
                a = at_a[k]
            else:
                m += 1
                b = at_b[m]
        irregular.append((first_a, k + 1, first_b, m + 1))
        i, j = 4 * k + 4, 4 * m + 4
    return irregular


def _last_of_group(n: int, firsts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Marks the last token of every group; firsts and ends are of the irregular ones."""
    inner = np.zeros(n + 1, np.int64)
    inner[firsts] += 1
    inner[ends - 1] -= 1  # a group of one token cancels out
    return np.cumsum(inner[:n]) == 0


class Aligner:
    """Both tokenizers of a worker, and the alignment of texts by them."""

    def __init__(self, raw_a: bytes, raw_b: bytes, pattern: str):
        self.a, self.b = ByteLevel(raw_a, pattern), Pieces(raw_b)
        self.size_b = len(self.b.sizes)
        size_a = len(self.a.sizes)
        self.behind_b = 2 * size_a
        spelled = [f"{i}{s}" for i in range(size_a) for s in ",|"]
        spelled += [f"{i}{s}" for i in range(self.size_b) for s in ",;"]
        self.spelled = np.array([s.encode() for s in spelled])  # padded with zero bytes

    def part(self, part: str):
        """Ids, marks of the last tokens of groups, and links as id pairs; None if the
        tokens do not spell the part."""
        if SPACE in part:
            return None
        a = np.array(self.a.encode(part), np.int64)
        b = self.b.encode(part)
        ends_a = np.cumsum(self.a.sizes[a], dtype=np.int32)
        ends_b = np.cumsum(self.b.sizes[b], dtype=np.int32)
        if ends_a[-1] != ends_b[-1] or ends_a[-1] != len(part.encode()):
            return None
        bounds = np.array(align(ends_a, ends_b), np.int64).reshape(-1, 4)
        last_a = _last_of_group(len(a), bounds[:, 0], bounds[:, 1])
        last_b = _last_of_group(len(b), bounds[:, 2], bounds[:, 3])
        # a link ends where a token of either ends
        inner = np.flatnonzero(~last_b)
        links = np.concatenate([
            a * self.size_b + b[np.searchsorted(ends_b, ends_a)],
            a[np.searchsorted(ends_a, ends_b[inner])] * self.size_b + b[inner],
        ])
        return a, b, last_a, last_b, links

    def spell(self, a, b, last_a, last_b) -> bytes:
        """``a1,a2|b1;...`` with a semicolon behind each group."""
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        stop_a, stop_b = np.flatnonzero(last_a) + 1, np.flatnonzero(last_b) + 1
        codes = np.empty(len(a) + len(b), np.int64)
        begin_b = np.concatenate([[0], stop_b[:-1]])
        codes[np.arange(len(a)) + begin_b[group_a]] = 2 * a + last_a
        codes[np.arange(len(b)) + stop_a[group_b]] = self.behind_b + 2 * b + last_b
        return self.spelled[codes].tobytes().translate(None, b"\0")

    def groups(self, text: str) -> list[tuple[list[int], list[int]]]:
        """The groups of a whole text as ids of A and of B."""
        made = [self.part(p) for p in parts_of(text)]
        if not text or None in made:
            return []
        out = []
        for a, b, last_a, last_b, _ in made:
            split_a = np.split(a, np.flatnonzero(last_a)[:-1] + 1)
            split_b = np.split(b, np.flatnonzero(last_b)[:-1] + 1)
            out += [(x.tolist(), y.tolist()) for x, y in zip(split_a, split_b, strict=True)]
        return out

    def document(self, text: str) -> tuple:
        """Counts and digest, and the sorted id pairs linked with their numbers of links."""
        digest, counts, pairs = hashlib.sha256(), [0, 0, 0, 0], []
        for k, p in enumerate(parts_of(text)):
            made = self.part(p)
            if made is None:
                pairs = []
                break
            a, b, last_a, last_b, links = made
            spelled = self.spell(a, b, last_a, last_b)
            digest.update((b";" if k else b"") + spelled[:-1])
            pairs.append(links)
            of_part = len(a), len(b), int(last_a.sum()), len(links)
            counts = [x + y for x, y in zip(counts, of_part, strict=True)]
        if not pairs:
            return 0, 0, 0, 0, "", [], []
        pair, times = np.unique(np.concatenate(pairs), return_counts=True)
        return *counts, digest.hexdigest(), pair, times


def parts_of(text: str) -> list[str]:
    """A space and the text, in parts; none for an empty text."""
    text = " " + text
    out, at = [], 0
    while len(text) - at > PART and (cut := _CUT.search(text, at + PART)):
        out.append(text[at : cut.start()])
        at = cut.start()
    return [*out, text[at:]] if len(text) > 1 else []


@lru_cache(1)
def aligner(raw_a: bytes, raw_b: bytes, pattern: str) -> Aligner:
    return Aligner(raw_a, raw_b, pattern)


def _read(name: str) -> bytes:
    with open(name, "rb") as file:  # a vocabulary, of fixed size
        return file.read()


NEW = (
    "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
    "pair array<bigint>, times array<int>"
)


def linked_pairs(
    docs: DataFrame, file_a: str, file_b: str, pattern: str, keep: list[str], text: str = "text"
) -> DataFrame:
    """Columns ``keep``, counts and digest of each document, and its linked id pairs."""
    shared = docs.sparkSession.sparkContext.broadcast((_read(file_a), _read(file_b), pattern))

    def compute(part, _):
        own = aligner(*shared.value)
        made = [own.document(x or "") for x in part.column(text).to_pylist()]
        columns = [list(c) for c in zip(*made, strict=True)] or [[]] * 7
        ends = np.cumsum([0, *map(len, columns[5])]).astype(np.int32)
        for k, kind in ((5, np.int64), (6, np.int32)):
            flat = np.concatenate([np.zeros(0, kind), *columns[k]]).astype(kind)
            columns[k] = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
        return columns

    return over_texts(docs, keep, NEW, compute, text)


def _slices(batches):
    """Runs of rows with at most about ``KEPT_PAIRS`` pairs, one row at least."""
    for batch in batches:
        ends = np.cumsum(batch.column("pair").value_lengths().to_numpy())
        at = 0
        while at < len(batch):
            before = ends[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(ends, before + KEPT_PAIRS, "right")))
            yield batch.slice(at, end - at)
            at = end


def pair_counts(pairs: DataFrame, size_b: int) -> DataFrame:
    """Links of each id pair in all documents, and whether its B id has none of more."""

    def run(batches):
        codes, sums = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in _slices(batches):
            new = batch.column("pair").flatten().to_numpy()
            times = batch.column("times").flatten().to_numpy()
            codes, back = np.unique(np.concatenate([codes, new]), return_inverse=True)
            sums = np.bincount(back, np.concatenate([sums, times]), len(codes)).astype(np.int64)
            if len(codes) > KEPT_PAIRS:
                yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(sums)], ["pair", "n"])
                codes, sums = codes[:0], sums[:0]
        yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(sums)], ["pair", "n"])

    importable(pairs.sparkSession)
    summed = (
        pairs.select("pair", "times").mapInArrow(run, "pair long, n long")
        .groupBy("pair").agg(F.sum("n").alias("n"))
    )
    b = F.pmod("pair", F.lit(size_b)).alias("b")
    # at most as many rows for a B id as A has ids
    most = summed.groupBy(b).agg(F.max("n").alias("most"))
    return summed.withColumn("b", b).join(most, "b").select(
        "pair", "n", (F.col("n") == F.col("most")).alias("best")
    )


def _looked_up(pairs: DataFrame, block: DataFrame) -> DataFrame:
    """Sums over each row's pairs of what the block holds of them."""
    spark = pairs.sparkSession
    table = block.orderBy("pair").toArrow()
    shared = spark.sparkContext.broadcast(
        tuple(table.column(c).to_numpy() for c in ("pair", "n", "best"))
    )

    def run(batches):
        codes, n, best = shared.value
        for batch in _slices(batches):
            lists = batch.column("pair")
            of = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
            own = lists.flatten().to_numpy()
            times = batch.column("times").flatten().to_numpy()
            sums = [np.zeros(len(lists), np.int64)] * 2
            if len(codes) and len(own):
                at = np.minimum(np.searchsorted(codes, own), len(codes) - 1)
                links = np.where(codes[at] == own, times, 0).astype(np.int64)
                total = np.zeros((2, len(lists)), np.int64)
                np.add.at(total[0], of, links * best[at])
                np.add.at(total[1], of, links * n[at])
                sums = list(total)
            rest = [batch.column(c) for c in names[:-2]]
            yield pa.RecordBatch.from_arrays([*rest, *map(pa.array, sums)], names)

    names = [c for c in pairs.columns if c not in ("pair", "times")] + ["n_best", "count_sum"]
    schema = pairs.drop("pair", "times").schema.add("n_best", "long").add("count_sum", "long")
    return pairs.mapInArrow(run, schema)


def align_documents(
    docs: DataFrame,
    file_a: str,
    file_b: str,
    pattern: str,
    keep: list[str],
    text: str = "text",
    most_pairs: int = PAIRS,
) -> DataFrame:
    """Columns ``keep``, and of each document its tokens, groups and links by number, the
    links that are the best of their B id, the sum of counts, and the groups' digest."""
    pairs = linked_pairs(docs, file_a, file_b, pattern, keep, text)
    pairs = stage(pairs.withColumn("_row", F.monotonically_increasing_id()), "linked-pairs")
    counts = stage(pair_counts(pairs, len(model_of(_read(file_b)).pieces)), "pair-counts")
    blocks = max(1, -(-counts.count() // most_pairs))
    block = F.pmod(F.xxhash64("pair"), F.lit(blocks))
    found = [_looked_up(pairs, counts.where(block == k)) for k in range(blocks)]
    if blocks == 1:
        return found[0].drop("_row")
    each = found[0].unionByName(found[1])
    for f in found[2:]:
        each = each.unionByName(f)
    rest = [c for c in pairs.columns if c not in ("pair", "times", "_row")]
    return each.groupBy("_row").agg(
        *[F.first(f"`{c}`").alias(c) for c in rest],
        *[F.sum(c).alias(c) for c in ("n_best", "count_sum")],
    ).drop("_row")
