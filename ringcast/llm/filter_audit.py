"""What each filter of a text pipeline removes, in every order, kept up to date by a stream.

Five filters judge a whole text (null: empty; words are ``[^\\x20\\x09-\\x0D]+``).  A text
fails A with under 50 words; B with under 65 % distinct words; C with over 5 % of its
characters of A-Z; D if it holds one of ``#$%&*|``; E if a smaller id has the same text.

Files are streamed as available-now micro-batches.  A to D need a text alone and give a
mask.  E depends on ids that may come later, so counters of masks per part are corrected
as they do: keyed state holds for each text (by its SHA-256) the least id seen so far,
with the parts and labels of the rows that have it.  A row with a greater id counts as
failing E.  When a smaller id arrives, the former holder's mask is retracted from its
part's counter and counted again with E; the new one is counted without.  Each batch
writes its changes of counters to a folder named by the batch, so a replay overwrites
its own; their sum is exact after every batch.

Before the shuffle, a task merges the rows of a text: only its least id goes to the
state, all others certainly fail E and go straight to the counters, so a text that makes
up a third of all rows is one row per task.  State entries are grouped in ``buckets`` of
texts for the calls of Python; each text is an entry of its own in the state store, which
is RocksDB, so state is bounded by disk and not by memory.

Rows without an id fail E never and make no other row fail it; rows alike in id and text
do not make each other fail.  Labels of an id are its greatest ones; rows without label
count for none.  A null part is the empty string.  Parts have a row for every order and
step; without documents there is none.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
from collections import Counter
from itertools import permutations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from ringcast.llm.texts import importable, slices
from ringcast.session import shared_dir, stage

FILTERS = "ABCDE"
REPEATED = 1 << FILTERS.index("E")
MIN_WORDS, MIN_DISTINCT, MAX_UPPER = 50, 65, 5
SYMBOLS = b"#$%&*|"
UPPER = bytes(range(65, 91))

BATCHES = 4  # micro-batches that the files of a table make
BUCKETS = 480  # calls of the state function per micro-batch, at most
MERGED = 100_000  # texts merged in a task before they are given out

STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": STORE,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # else each partition reserves megabytes for its logs, however little it holds
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def mask_of(raw: bytes) -> int:
    """Bits of the filters among A to D that a text fails."""
    words = raw.split()
    points = len(raw) - len(raw.translate(None, _CONTINUED)) if not raw.isascii() else 0
    failed = (
        len(words) < MIN_WORDS,
        100 * len(set(words)) < MIN_DISTINCT * len(words),
        100 * (len(raw) - len(raw.translate(None, UPPER))) > MAX_UPPER * (len(raw) - points),
        len(raw.translate(None, SYMBOLS)) < len(raw),
    )
    return sum(bit << i for i, bit in enumerate(failed))


_CONTINUED = bytes(range(0x80, 0xC0))

MASKED = "id long, part string, digest binary, mask int, n long"


def masked(docs: DataFrame, key: str, part: str, text: str) -> DataFrame:
    """Digest and mask of every text; neighbours alike in id, part and text are merged."""
    importable(docs.sparkSession)
    read = docs.select(
        F.col(f"`{key}`").cast("long").alias("id"),
        F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"),
        F.col(f"`{text}`").alias("text"),
    )

    def run(batches):
        for batch in batches:
            for rows in slices(batch, "text"):
                found: Counter = Counter()
                masks = {}
                columns = (rows.column(c).to_pylist() for c in ("id", "part", "text"))
                for i, p, t in zip(*columns, strict=True):
                    raw = (t or "").encode()
                    digest = hashlib.sha256(raw).digest()
                    if digest not in masks:
                        masks[digest] = mask_of(raw)
                    found[i, p, digest] += 1
                yield _batch(MASKED, [(*k, masks[k[2]], n) for k, n in found.items()])

    return read.mapInArrow(run, MASKED)


_KINDS = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}


def _names(schema: str) -> list[str]:
    return [field.split()[0] for field in schema.split(", ")]


def _batch(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    kinds = [_KINDS[field.split()[1]] for field in schema.split(", ")]
    columns = zip(*rows, strict=True) if rows else [()] * len(kinds)
    arrays = [pa.array(list(c), t) for c, t in zip(columns, kinds, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, _names(schema))


MERGEABLE = "bucket int, digest binary, id long, part string, mask int, good int, toxic int, n long"


def merged(rows: DataFrame, buckets: int) -> DataFrame:
    """Rows of the least id of each text in a task, and counts of the others without digest."""

    def run(batches):
        least: dict[bytes, tuple[int, Counter]] = {}
        sure: Counter = Counter()  # rows whose mask is final

        def give():
            out = [
                (int.from_bytes(d[:4], "big") % buckets, d, i, p, m, g, t, n)
                for d, (i, held) in least.items() for (p, m, g, t), n in held.items()
            ]
            for (p, m, g, t), n in sure.items():
                spread = hashlib.blake2b(f"{p}:{m}{g}{t}".encode(), digest_size=4).digest()
                bucket = int.from_bytes(spread, "big") % buckets
                out.append((bucket, b"", 0, p, m, g, t, n))
            least.clear()
            sure.clear()
            return _batch(MERGEABLE, out)

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in names)
            for i, p, d, m, g, t, n in zip(*columns, strict=True):
                if i is None:
                    sure[p, m, g, t] += n
                    continue
                now = least.get(d)
                if now is None or i < now[0]:
                    least[d] = i, Counter({(p, m, g, t): n})
                    for (p, m, g, t), n in now[1].items() if now else ():
                        sure[p, m | REPEATED, g, t] += n
                elif i == now[0]:
                    now[1][p, m, g, t] += n
                else:
                    sure[p, m | REPEATED, g, t] += n
            if len(least) + len(sure) > MERGED:
                yield give()
        yield give()

    names = ["id", "part", "digest", "mask", "good", "toxic", "n"]
    return rows.select(*names).mapInArrow(run, MERGEABLE)


CHANGES = "part string, mask int, good int, toxic int, n long"


class LeastIds(StatefulProcessor):
    """State of texts: the least id, and the counted rows that have it."""

    def init(self, handle) -> None:
        key = T.StructType().add("digest", T.BinaryType())
        value = T.StructType().add("id", T.LongType()).add("held", T.StringType())
        self.texts = handle.getMapState("texts", key, value)

    def handleInputRows(self, key, rows, timerValues):
        changes: Counter = Counter()
        arrived: dict[bytes, dict[int, Counter]] = {}
        for frame in rows:
            values = (frame[c].tolist() for c in frame.columns if c != "bucket")
            for digest, i, part, mask, good, toxic, n in zip(*values, strict=True):
                row = part, int(mask), int(good), int(toxic)
                if not digest:  # final in its task
                    changes[row] += n
                else:
                    arrived.setdefault(bytes(digest), {}).setdefault(int(i), Counter())[row] += n
        for digest, ids in arrived.items():
            i = min(ids)
            stored = self.texts.getValue((digest,))
            if stored is not None and stored[0] <= i:
                if stored[0] == i:  # more rows of the same id
                    held = _held(stored[1])
                    held.update(ids[i])
                    changes.update(ids.pop(i))
                    self.texts.updateValue((digest,), (i, _text(held)))
            else:
                if stored is not None:
                    for (part, mask, good, toxic), n in _held(stored[1]).items():
                        changes[part, mask, good, toxic] -= n  # retracted
                        changes[part, mask | REPEATED, good, toxic] += n
                held = ids.pop(i)
                changes.update(held)
                self.texts.updateValue((digest,), (i, _text(held)))
            for rest in ids.values():
                for (part, mask, good, toxic), n in rest.items():
                    changes[part, mask | REPEATED, good, toxic] += n
        out = [(*row, n) for row, n in changes.items() if n]
        yield pd.DataFrame(out, columns=_names(CHANGES))

    def close(self) -> None:
        pass


def _text(held: Counter) -> str:
    return json.dumps([[*row, n] for row, n in held.items()])


def _held(text: str) -> Counter:
    return Counter({tuple(row): n for *row, n in json.loads(text)})


def best_labels(labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """Whether any label row of an id says good, and toxic."""
    return labels.where(F.col(key).isNotNull()).groupBy(F.col(key).cast("long").alias("id")).agg(
        F.coalesce(F.max((F.col("quality") == 1).cast("int")), F.lit(0)).alias("good"),
        F.coalesce(F.max((F.col("toxic") == 1).cast("int")), F.lit(0)).alias("toxic"),
    )


def update_counters(
    stream: DataFrame,
    labels: DataFrame,
    folder: str,
    key: str = "doc_id",
    part: str = "source",
    text: str = "text",
    buckets: int = BUCKETS,
) -> None:
    """Run the stream's new files through; ``folder`` keeps state and changes of counters.

    ``labels`` (id, good, toxic) are read again by every micro-batch.
    """
    spark = stream.sparkSession
    rows = masked(stream, key, part, text).join(labels, "id", "left").fillna(0, ["good", "toxic"])
    changes = (
        merged(rows, buckets).groupBy("bucket")
        .transformWithStateInPandas(LeastIds(), CHANGES, "update", "none")
    )

    def write(batch: DataFrame, number: int) -> None:
        summed = batch.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n"))
        summed.write.mode("overwrite").parquet(f"{folder}/changes/batch={number}")

    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    try:
        for k, v in SETTINGS.items():
            spark.conf.set(k, v)
        query = (
            changes.writeStream.foreachBatch(write).outputMode("update")
            .option("checkpointLocation", f"{folder}/checkpoint")
            .trigger(availableNow=True).start()
        )
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    query.awaitTermination()


def counters(spark: SparkSession, folder: str) -> DataFrame:
    """Rows per part, mask and labels, after all batches so far."""
    return (
        spark.read.schema(CHANGES).parquet(f"{folder}/changes/*")
        .groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n"))
    )


def steps() -> list[tuple[str, int, int, int]]:
    """Every order and step with the step's filter and those before it, as bits."""
    out = []
    for order in permutations(range(len(FILTERS))):
        name, before = "".join(FILTERS[f] for f in order), 0
        for k, f in enumerate(order):
            out.append((name, k + 1, 1 << f, before))
            before |= 1 << f
    return out


def report(counts: DataFrame) -> DataFrame:
    """A row per part, order and step from the counters of masks.

    A step's counts depend on its filter and the set of those before it, not on their
    order, so they are summed for the 80 such pairs and then given to the 600 steps.
    """
    spark = counts.sparkSession
    orders = spark.createDataFrame(
        steps(), "filter_order string, step int, filter int, before int"
    )
    weights = Counter((f, before) for _, _, f, before in steps())
    sets = F.array(*[
        F.struct(F.lit(f).alias("filter"), F.lit(b).alias("before"), F.lit(w).alias("times"))
        for (f, b), w in sorted(weights.items())
    ])
    masks = counts.groupBy("part", "mask").agg(
        F.sum("n").alias("n"),
        F.sum(F.col("n") * F.col("good")).alias("good"),
        F.sum(F.col("n") * F.col("toxic")).alias("toxic"),
    )
    mask, own, before = F.col("mask"), F.col("filter"), F.col("before")
    fails, gone = mask.bitwiseAND(own) != 0, mask.bitwiseAND(before) != 0

    def total(when, of="n"):
        return F.sum(F.when(when, F.col(of)).otherwise(0)).cast("long")

    known = masks.select("*", F.explode(sets).alias("s")).select(*masks.columns, "s.*")
    summed = known.groupBy("part", "filter", "before", "times").agg(
        total(~fails & ~gone).alias("kept"),
        total(fails & ~gone).alias("removed"),
        total(fails & gone).alias("redundant"),
        total(mask == own).alias("unique_fails"),
        total(fails & ~gone, "good").alias("good_lost"),
        total(fails & ~gone, "toxic").alias("toxic_lost"),
    )
    over = Window.partitionBy("part", "filter")  # 16 rows
    shapley = F.sum(F.col("removed") * F.col("times")).over(over).alias("shapley")
    each = summed.select("*", shapley).join(F.broadcast(orders), ["filter", "before"])
    return each.drop("filter", "before", "times")


def audit_files(
    spark: SparkSession,
    path: str,
    labels: DataFrame,
    batches: int = BATCHES,
    folder: str | None = None,
    **named,
) -> DataFrame:
    """The report over all parquet files of ``path``, streamed in about ``batches`` batches.

    With a ``folder`` of an earlier call, only files that are new since are read.
    """
    table = spark.read.parquet(path)
    files = max(1, -(-len(table.inputFiles()) // batches))
    # as a pattern, a table may be one file or a folder of files
    pattern = f"{path[:-1]}[{path[-1]}]"
    stream = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", files)
    folder = folder or f"{shared_dir(spark)}/ringcast/filter-audit-{np.random.default_rng().bytes(8).hex()}"
    update_counters(stream.parquet(pattern), stage(labels, "best-labels"), folder, **named)
    return report(counters(spark, folder))
