"""Near-duplicate classes by consistent weighted sampling of TF-IDF shingles.

A text is a weighted set of its runs of five words (all its words, if fewer): a shingle
weighs its count times ``sqrt(1 + ln(N / df))``.  Document frequencies are counted over
all documents in a sketch of fixed size, hashed to ``SKETCH`` cells; so frequent shingles
weigh less, and those rarer than a cell's chance load weigh the same at every corpus size.

Improved consistent weighted sampling draws ``BANDS * ROWS`` samples per text, such that
two texts agree in one with the probability of their weighted Jaccard similarity (sum of
the least over sum of the greatest weights).  Texts that agree in all samples of a band
meet in a bucket.  Similarities are computed from the sets; 0.8 or more makes a link, and
a class is a connected component of links.  At 0.8 exactly two texts miss each other with
probability (1 - 0.8^ROWS)^BANDS, 0.0002.

Equal texts are one node.  Before two sets are compared, their samples and weights must
allow the similarity: of 64 samples, 52 are expected to agree at 0.8, and 39 have to; and
the weights shared in each of ``PARTS`` parts of the hash range are at most the lesser of
both texts' weights there, which bounds the similarity from above.
In a bucket nodes are not compared all with all, but with a few pivots, those first that share most buckets with others.  Links then join nodes, and
only nodes outside of a bucket's largest component become pivots of the next round, many
times as many as before, until a bucket is one component or each of its outsiders has
been a pivot.  So every two nodes of a bucket are in one component or were compared, save
those that samples and weights rule out.  No group is gathered in one
task: pivots are chosen by limited ranking, and large joins are left to be split.

A text without a word is a class of its own.  The class id is the least key of a class,
null if all its keys are null.  Repeated rows are equal texts.  An empty table gives an
empty result.  Only key and text are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ringcast.llm.texts import Shelf, Texts, end_of_task, importable, mix, over_texts, slices
from ringcast.session import stage

SHINGLE, SIMILARITY = 5, 0.8
BANDS, ROWS = 16, 4
PARTS, PART_STEPS = 128, 32_000  # of the hash range; steps of weight (two bytes hold them)
MORE_PIVOTS = 12  # times as many in the next round
MOST_DIFFERENT = 25  # of the samples, by four bits of each
SKETCH = 1 << 18
CHANCES = 1 << 15  # rows of the table of random numbers
TOGETHER = 4096  # shingles sampled at once
ROWS_EACH = 100_000  # rows of a partition of links and labels
FILTER_WORDS = 1 << 18  # of 64 bits each, in a filter of rows
SEED = 20240101

_chances = Shelf()


def _cell(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - 18)).astype(np.int64)


def chances() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """r, 1 / r, ln c and beta for each row and sample; a process makes them once."""

    def make():
        random = np.random.default_rng(SEED)
        shape = (CHANCES, BANDS * ROWS)
        r = random.gamma(2.0, 1.0, shape).astype(np.float32)
        c = np.log(random.gamma(2.0, 1.0, shape)).astype(np.float32)
        beta = random.random(shape, dtype=np.float32)
        return r, (1 / r).astype(np.float32), c, beta

    return _chances.get("chances", make)


def weighted_sets(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, hash and count of each text's distinct shingles, in order of hash."""
    hashes, of, _ = texts.shingles(SHINGLE)
    order = np.lexsort((hashes, of))
    hashes, of = hashes[order], of[order]
    first = np.ones(len(hashes), bool)
    first[1:] = (hashes[1:] != hashes[:-1]) | (of[1:] != of[:-1])
    at = np.flatnonzero(first)
    return of[at], hashes[at], np.diff(np.append(at, len(hashes)))


def sketch(docs: DataFrame, text: str) -> tuple[np.ndarray, int]:
    """Document frequency by cell, and the number of texts with a word."""
    importable(docs.sparkSession)

    def run(batches):
        counts, with_words = np.zeros(SKETCH, np.int64), 0
        for batch in batches:
            for part in slices(batch, text):
                of, hashes, _ = weighted_sets(Texts.of(part.column(text)))
                counts += np.bincount(_cell(hashes), minlength=SKETCH)
                with_words += len(np.unique(of))
        cells = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.append(cells, -1)),
                pa.array(np.append(counts[cells], with_words)),
            ],
            ["cell", "n"],
        )
        end_of_task()

    found = (
        docs.select(text).mapInArrow(run, "cell bigint, n bigint").groupBy("cell")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )  # SKETCH + 1 rows at most
    counts = np.zeros(SKETCH + 1, np.int64)
    counts[found.column("cell").to_numpy()] = found.column("n").to_numpy()
    return counts[:-1], int(counts[-1])


def log_weights(counts: np.ndarray, n: int) -> np.ndarray:
    """ln of the weight of one occurrence, by cell; a cell's count is an upper bound."""
    share = max(n, 1) / np.maximum(counts, 1)
    return (0.5 * np.log(1 + np.log(np.maximum(share, 1)))).astype(np.float32)


def weights_of(hashes: np.ndarray, times: np.ndarray, logs: np.ndarray) -> np.ndarray:
    return (np.exp(logs[_cell(hashes)]) * times).astype(np.float32)


def samples(hashes: np.ndarray, log_weight: np.ndarray) -> np.ndarray:
    """BANDS * ROWS samples of one weighted set, as hashes of shingle and level.

    Shingles that share a row of the table compete by weight, and then by hash.
    """
    r, inverse, log_c, beta = chances()
    least = np.full(BANDS * ROWS, np.inf, np.float32)
    chosen = np.zeros(BANDS * ROWS, np.uint64)
    level = np.zeros(BANDS * ROWS, np.float32)
    every = np.arange(BANDS * ROWS)
    for i in range(0, len(hashes), TOGETHER):
        some = hashes[i : i + TOGETHER]
        rows = (some & np.uint64(CHANCES - 1)).astype(np.int64)
        b = beta[rows]
        t = np.floor(log_weight[i : i + TOGETHER, None] * inverse[rows] + b)
        value = log_c[rows] - r[rows] * (t - b + 1)
        at = value.argmin(0)
        found = value[at, every]
        better = found < least
        least[better] = found[better]
        chosen[better] = some[at[better]]
        level[better] = t[at, every][better]
    return chosen + level.astype(np.int64).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)


def band_keys(drawn: np.ndarray) -> np.ndarray:
    """One key per band, of texts x samples."""
    parts = mix(drawn).reshape(-1, BANDS, ROWS)
    key = np.zeros(parts.shape[:2], np.uint64) + np.arange(BANDS, dtype=np.uint64)
    for j in range(ROWS):
        key = mix(key * np.uint64(31) + parts[:, :, j])
    return key.view(np.int64)


def lanes(drawn: np.ndarray) -> np.ndarray:
    """Four bits of each sample, sixteen samples to a number, of texts x samples."""
    bits = (mix(drawn) & np.uint64(15)).reshape(len(drawn), -1, 16)
    places = np.uint64(4) * np.arange(16, dtype=np.uint64)
    return (bits << places).sum(2, dtype=np.uint64).view(np.int64)


def _signed(logs):
    def compute(_, texts):
        of, hashes, times = weighted_sets(texts)
        weight = logs.value[_cell(hashes)] + np.log(times).astype(np.float32)
        bounds = np.searchsorted(of, np.arange(len(texts) + 1))
        out: list = [None] * len(texts)
        packed: list = [None] * len(texts)
        filled = np.flatnonzero(np.diff(bounds))
        if len(filled):
            drawn = np.stack(
                [
                    samples(hashes[bounds[i] : bounds[i + 1]], weight[bounds[i] : bounds[i + 1]])
                    for i in filled
                ]
            )
            for i, keys, four in zip(filled, band_keys(drawn), lanes(drawn), strict=True):
                out[i], packed[i] = keys, four
        return [out, packed]

    return compute


def _vectors(logs):
    """Weights by part of the hash range, in steps of a unit, rounded up; the unit; the
    total weight; the set."""

    def compute(_, texts):
        of, hashes, times = weighted_sets(texts)
        weight = weights_of(hashes, times, logs.value)
        bounds = np.searchsorted(of, np.arange(len(texts) + 1))
        ends = list(zip(bounds[:-1], bounds[1:], strict=True))
        part = (hashes >> np.uint64(20)).astype(np.int64) % PARTS
        parts = np.bincount(of * PARTS + part, weight.astype(np.float64), len(texts) * PARTS)
        parts = parts.reshape(-1, PARTS)
        unit = np.maximum(parts.max(1, initial=0), 1e-9) / (PART_STEPS - 1)
        return [
            list(np.ceil(parts / unit[:, None]).astype(np.int32)),
            unit,
            [float(weight[a:b].sum(dtype=np.float64)) for a, b in ends],
            [hashes[a:b].tobytes() + weight[a:b].tobytes() for a, b in ends],
        ]

    return compute


def similarity(a: bytes, b: bytes) -> float:
    """Weighted Jaccard similarity of two sets: sorted hashes, then weights."""

    def parts(raw):
        n = len(raw) // 12
        return np.frombuffer(raw, np.uint64, n), np.frombuffer(raw, np.float32, n, 8 * n)

    (ha, wa), (hb, wb) = parts(a), parts(b)
    if len(ha) > len(hb):
        ha, wa, hb, wb = hb, wb, ha, wa
    at = np.searchsorted(hb, ha)
    at[at == len(hb)] = 0
    same = hb[at] == ha if len(hb) else np.zeros(0, bool)
    shared = np.minimum(wa[same], wb[at[same]]).sum(dtype=np.float64)
    total = wa.sum(dtype=np.float64) + wb.sum(dtype=np.float64) - shared
    return float(shared / total) if total > 0 else 0.0


def _compared(pairs: DataFrame, vectors: DataFrame) -> DataFrame:
    """Pairs a, b with whether they are linked."""
    left = vectors.select(F.col("node").alias("a"), F.col("vector").alias("va"))
    right = vectors.select(F.col("node").alias("b"), F.col("vector").alias("vb"))
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "va", "vb")
    schema = "a binary, b binary, linked boolean"

    def run(batches):
        for batch in batches:
            va, vb = batch.column("va").to_pylist(), batch.column("vb").to_pylist()
            linked = [similarity(x, y) >= SIMILARITY for x, y in zip(va, vb, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), pa.array(linked, pa.bool_())],
                ["a", "b", "linked"],
            )
        end_of_task()

    return joined.mapInArrow(run, schema)


def _sized(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """The staged frame in as many partitions as its rows need, and their number.

    Few links or labels are then joined and summed without a shuffle.
    """
    staged = stage(df, name)
    n = staged.count()
    return staged.coalesce(max(1, -(-n // ROWS_EACH))), n


def components(edges: DataFrame) -> DataFrame:
    """The least node of its component, ``root``, for each node of the edges (a, b).

    Every node hooks onto its least neighbour, chains are halved until all point at their
    end, and edges between ends go on to the next turn.
    """
    roots = None
    edges, n = _sized(edges.where("a <> b").distinct(), "component-edges")
    while n:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = both.groupBy(F.col("a").alias("node")).agg(
            F.least(F.min("b"), F.col("a")).alias("root")
        )
        hooks, _ = _sized(hooks, "component-hooks")
        while True:
            ends = hooks.select(F.col("node").alias("root"), F.col("root").alias("next"))
            beyond = hooks.select(F.col("node").alias("next"), F.col("root").alias("end"))
            longer = hooks.join(ends, "root").join(beyond, "next").select("node", "root", "end")
            longer, _ = _sized(longer, "component-chains")
            done = longer.where("end <> root").isEmpty()
            hooks = longer.select("node", F.col("end").alias("root"))
            if done:
                break
        if roots is None:
            roots = hooks
        else:
            moved = roots.select("node", F.col("root").alias("via")).join(
                hooks.select(F.col("node").alias("via"), "root"), "via", "left"
            )
            roots, _ = _sized(
                moved.select("node", F.coalesce("root", "via").alias("root")), "component-roots"
            )
        ends = hooks.select("node", "root")
        edges = (
            edges.join(ends.toDF("a", "ra"), "a")
            .join(ends.toDF("b", "rb"), "b")
            .where("ra <> rb")
            .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b"))
            .distinct()
        )
        edges, n = _sized(edges, "component-edges")
    if roots is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots


def _maybe_similar(x: str, y: str) -> Column:
    """Whether two nodes' samples agree often enough: at 0.8 all but 1 pair in 24,000."""
    differ = F.lit(0)
    for i in range(BANDS * ROWS // 16):
        odd = F.col(f"{x}.lanes")[i].bitwiseXOR(F.col(f"{y}.lanes")[i])
        odd = odd.bitwiseOR(F.shiftrightunsigned(odd, 1))
        odd = odd.bitwiseOR(F.shiftrightunsigned(odd, 2))
        differ = differ + F.bit_count(odd.bitwiseAND(0x1111111111111111))
    return differ <= MOST_DIFFERENT


def _joined_nodes(members: DataFrame, facts: DataFrame, vectors: DataFrame) -> DataFrame:
    """Component of each node that meets others in a bucket: node, root.

    ``members`` has bucket, node and score, one row per meeting; ``facts`` the total
    weight, samples and bands of each node. A pair that meets in several buckets is
    looked at in that of its first common band only.
    """
    members = members.withColumns({"root": F.col("node"), "used": F.lit(False)})
    labels = members.select("node", "root").distinct()
    pivots_each, last = 1, False
    while True:
        if pivots_each == 1:
            open_ = outside = members
        else:
            sizes = members.repartition("bucket")
            sizes = sizes.groupBy("bucket", "root").agg(F.count("*").alias("n"))
            sizes = sizes.groupBy("bucket").agg(
                F.max(F.struct("n", "root")).alias("top"), F.sum("n").alias("n")
            )
            sizes, _ = _sized(
                sizes.where("n > top.n").select(
                    "bucket", F.col("top.root").alias("top"), (F.col("n") - F.col("top.n")).alias("n")
                ),
                "dedup-open",
            )
            most = sizes.agg(F.max("n")).first()[0]
            if most is None:
                return labels
            last = most <= pivots_each
            sizes = sizes.drop("n")
            open_ = stage(members.join(sizes, "bucket"), "dedup-open-members")
            outside = open_.where("root <> top and not used").drop("top")
            open_ = open_.drop("top")
        rank = F.row_number().over(
            Window.partitionBy("bucket").orderBy(F.desc("score"), "node")
        )
        pivots = outside.withColumn("place", rank).where(F.col("place") <= pivots_each)
        chosen, _ = _sized(pivots.select("bucket", "node", "root"), "dedup-chosen")
        pivots, _ = _sized(chosen.join(facts, "node"), "dedup-pivots")
        least = F.least("x.total", "y.total")
        close = least >= (SIMILARITY - 1e-6) * F.greatest("x.total", "y.total")
        shared = F.aggregate(
            F.zip_with(
                "x.parts",
                "y.parts",
                lambda a, b: F.least(a * F.col("x.unit"), b * F.col("y.unit")),
            ),
            F.lit(0.0),
            lambda s, v: s + v,
        )
        possible = shared >= (SIMILARITY - 1e-6) * (
            F.col("x.total") + F.col("y.total") - shared
        )
        if pivots_each == 1:
            # one pivot in each bucket makes few pairs: the wide columns stay out
            known_facts, possible = facts.drop("parts", "unit"), F.lit(True)
        else:
            known_facts = facts
        xs, ys = F.col("x.bands"), F.col("y.bands")
        first = F.coalesce(*[F.when(xs[i] == ys[i], xs[i]) for i in range(BANDS)])
        pairs = (
            open_.where("not used")  # who was a pivot here has met all others
            .select("bucket", "node", "root")
            .join(known_facts, "node")
            .alias("x")
            .join(
                pivots.alias("y"),
                (F.col("x.bucket") == F.col("y.bucket"))
                & (F.col("x.root") != F.col("y.root"))
                & close
                & _maybe_similar("x", "y")
                & (first == F.shiftright(F.col("x.bucket"), 32).cast("int"))
                & possible,
            )
            .select(
                F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")
            )
            .repartition("a")
            .distinct()
        )
        checked = stage(_compared(pairs, vectors), "dedup-checked")

        links = checked.where("linked").select("a", "b")
        ends = labels.select("node", "root")
        between = links.join(ends.toDF("a", "ra"), "a").join(ends.toDF("b", "rb"), "b")
        moved = components(between.select(F.col("ra").alias("a"), F.col("rb").alias("b")))
        moved = moved.select(F.col("node").alias("root"), F.col("root").alias("to"))
        labels, _ = _sized(
            labels.join(moved, "root", "left")
            .select("node", F.coalesce("to", "root").alias("root")),
            "dedup-labels",
        )
        if last:
            return labels
        chosen = chosen.select("bucket", "node", F.lit(True).alias("pivot"))
        members = (
            open_.join(moved, "root", "left")
            .join(chosen, ["bucket", "node"], "left")
            .select("bucket", "node", "score", F.coalesce("to", "root").alias("root"),
                    (F.col("used") | F.col("pivot").isNotNull()).alias("used"))
        )
        members = stage(members, "dedup-members")
        pivots_each *= MORE_PIVOTS


def _node(text: str) -> Column:
    return F.unhex(F.md5(F.coalesce(F.col(f"`{text}`"), F.lit(""))))


def _word_and_bit(*columns: Column) -> tuple[Column, Column]:
    hashed = F.xxhash64(*[c.cast("string") for c in columns])
    word = hashed.bitwiseAND(F.lit(FILTER_WORDS - 1).cast("long"))
    return word, F.pmod(F.shiftright(hashed, 18), F.lit(64)).cast("int")


def row_filter(chosen: DataFrame, *names: str) -> DataFrame:
    """Bits of the hashes of chosen rows: ``FILTER_WORDS`` rows at most, whatever the input.

    It rules rows out before texts are shuffled; what it lets pass is joined exactly, so
    many chosen rows make it let more pass, and nothing else.
    """
    word, bit = _word_and_bit(*map(F.col, names))
    bits = chosen.select(word.alias("_word"), bit.alias("_bit")).withColumn(
        "_bit", F.expr("shiftleft(1L, _bit)")
    )
    return stage(bits.groupBy("_word").agg(F.bit_or("_bit").alias("_bits")), "dedup-filter")


def with_maybe(rows: DataFrame, bits: DataFrame, *names: str) -> DataFrame:
    """Adds ``_maybe``, false for rows that surely are not among those of the filter."""
    word, bit = _word_and_bit(*map(F.col, names))
    joined = rows.withColumns({"_at": word, "_bit": bit}).join(
        F.broadcast(bits), F.col("_at") == F.col("_word"), "left"
    )
    maybe = F.coalesce(F.bit_get("_bits", F.col("_bit")) == 1, F.lit(False))
    return joined.withColumn("_maybe", maybe).drop("_at", "_word", "_bit", "_bits")


def near_classes(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """For every row: key, ``node`` (the text's digest, null without words), ``class_id``
    and ``head``, the node whose text stands for the class."""
    spark = docs.sparkSession
    read = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    counts, n = sketch(read, "text")
    logs = spark.sparkContext.broadcast(log_weights(counts, n))  # SKETCH numbers

    signed = over_texts(
        read.withColumn("node", _node("text")), ["key", "node"],
        "bands array<bigint>, lanes array<bigint>", _signed(logs),
    )
    signed = stage(signed, "dedup-signed")
    rows = signed.select(
        "key", F.when(F.col("bands").isNotNull(), F.col("node")).alias("node")
    )
    nodes = stage(
        signed.where("bands is not null")
        .groupBy("node")
        .agg(F.min("key").alias("least"), F.first("bands").alias("bands"), F.first("lanes").alias("lanes")),
        "dedup-nodes",
    )

    meet = nodes.select("node", F.explode("bands").alias("bucket"))
    sizes = stage(
        meet.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1"), "dedup-buckets"
    )
    members = stage(meet.join(sizes, "bucket"), "dedup-meetings")
    scores = stage(members.groupBy("node").agg(F.sum("n").alias("score")), "dedup-scores")

    # one row of each node that meets others
    wanted = scores.select("node").join(nodes.select("node", "least"), "node")
    wanted = stage(wanted.select(F.col("node").alias("wanted"), "least"), "dedup-wanted")
    # by node and key, so that a text of very many rows is not one key of the join
    one = (F.col("node") == F.col("wanted")) & F.col("key").eqNullSafe(F.col("least"))
    bits = row_filter(wanted, "wanted", "least")
    texts = (
        with_maybe(read.withColumn("node", _node("text")), bits, "node", "key")
        .where("_maybe")
        .join(wanted, one)
        .select("node", "text")
        .dropDuplicates(["node"])
    )
    vectors = stage(
        over_texts(
            texts,
            ["node"],
            "parts array<int>, unit double, total double, vector binary",
            _vectors(logs),
        ),
        "dedup-vectors",
    )
    members = stage(members.select("bucket", "node").join(scores, "node"), "dedup-members")
    # what pairs are told apart by before their sets are read
    short = F.transform("bands", lambda b: F.shiftright(b, 32).cast("int"))
    parts = F.col("parts").cast("array<smallint>").alias("parts")
    facts = vectors.select("node", "total", "unit", parts).join(
        nodes.select("node", "lanes", short.alias("bands")), "node"
    )
    labels = _joined_nodes(members, stage(facts, "dedup-facts"), vectors)

    least = nodes.select("node", "least")
    joined = least.join(labels, "node", "left").withColumn("root", F.coalesce("root", "node"))
    heads = joined.groupBy("root").agg(
        F.min("least").alias("class_id"),
        F.min_by("node", F.struct(F.col("least").isNull(), "least", "node")).alias("head"),
    )
    classes = stage(
        joined.join(heads, "root").select("node", "class_id", "head"), "dedup-classes"
    )
    own = F.col("node").isNull()
    return rows.join(classes, "node", "left").select(
        F.col("key").alias(key),
        "node",
        F.when(own, F.col("key")).otherwise(F.col("class_id")).alias("class_id"),
        "head",
    )


def near_distinct(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of ``docs``, one of each class: the one with the least key.

    Of rows alike in key and text the first by their other columns stays.  Rows that are
    neither dropped nor repeated pass without a shuffle of their texts.
    """
    found = stage(near_classes(docs, key, text).withColumnRenamed(key, "key"), "dedup-found")
    stays = F.col("node").isNull() | (
        (F.col("node") == F.col("head")) & F.col("key").eqNullSafe(F.col("class_id"))
    )
    kept = stage(
        found.where(stays).groupBy("node", "key").agg(F.count("*").alias("n")), "dedup-kept"
    )
    doubtful = found.where(~stays).select("node", "key")
    doubtful = doubtful.unionByName(kept.where("n > 1").select("node", "key"))
    bits = row_filter(doubtful, "node", "key")

    columns = [F.col(f"`{c}`") for c in docs.columns]
    worded = F.col(f"`{text}`").rlike(r"[^\x20\x09-\x0D]")
    rows = docs.select(
        F.struct(*columns).alias("row"),
        F.when(worded, _node(text)).alias("node"),
        F.col(f"`{key}`").alias("key"),
    )
    rows = with_maybe(rows, bits, "node", "key")
    kept = kept.select(F.col("node").alias("kept_node"), F.col("key").alias("kept_key"))
    same = F.col("node").eqNullSafe(F.col("kept_node")) & F.col("key").eqNullSafe(
        F.col("kept_key")
    )
    others = F.struct(*[F.col("row")[n].alias(n) for n in docs.columns if n != text])
    single = Window.partitionBy("node", "key").orderBy("others")
    chosen = (
        rows.where("_maybe")
        .join(kept, same)
        .withColumn("others", F.to_json(others))
        .withColumn("place", F.row_number().over(single))
        .where("place = 1")
    )
    passed = rows.where("not _maybe").select("row.*")
    return passed.unionByName(chosen.select("row.*"))
