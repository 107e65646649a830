"""Mixing sources to target weights by Pareto order sampling.

A text's size is its number of words.  Sources in code point order, null last, get the
weights in turn, and share ``share`` of all words by them; no target is above
``max_copies`` times its source's words, and what exceeds that is shared out again.

Within a source every document is first taken as often as the target holds the whole
source.  The words that remain are drawn without replacement, longer texts likelier: a
document's inclusion probability p is in proportion to its size, 1 at most, so that the
expected words are those that remain.  Documents rank by ``odds(u) / odds(p)`` with u
from the hash of the key, those with p = 1 first, and the ranking is cut where the words
taken come nearest to the target.  The mix misses a target by half a text at most.

The cut needs no global order: words are summed by bins of the rank, the bin with the
cut is divided once more, and only the documents of one such bin are ordered.

Null and empty texts have size 0 and are never drawn.  Rows alike in key, source and
size are numbered, each number a draw of its own.  A null key counts as a key.  An empty
table gives an empty result.  Other columns are not read.

What a document draws depends on its key and on one row of its source alone, so the mix
itself is made where the texts are: only rows alike in key, source and size are shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ringcast.session import stage

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE, MAX_COPIES = 1.5, 2
BINS = 4096
DIGITS = 6  # of a target


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def source_targets(
    sizes: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    max_copies: int = MAX_COPIES,
) -> DataFrame:
    """One row per source: its size, target, certain copies and remaining words."""
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*map(F.lit, weights)), F.pmod(place - 1, len(weights)) + 1)
    most = max_copies * F.col("source_size")
    # fill the sources that run full first, then share what is left by weight
    by_need = Window.orderBy(F.col("most") / F.col("weight"), "place")
    before = by_need.rowsBetween(Window.unboundedPreceding, -1)
    all_rows = Window.partitionBy()

    def earlier(column):
        return F.coalesce(F.sum(column).over(before), F.lit(0))

    level = (share * F.sum("source_size").over(all_rows) - earlier("most")) / (
        F.sum("weight").over(all_rows) - earlier("weight")
    )
    return (
        sources.withColumns({"place": place, "weight": weight, "most": most})
        .withColumn("level", level)
        .withColumn("held", F.col("most") >= F.col("weight") * F.col("level"))
        .withColumn("level", F.max(F.when(F.col("held"), F.col("level"))).over(all_rows))
        .withColumn(
            "target",
            F.round(
                F.least(
                    F.col("most").cast("double"),
                    F.coalesce(F.col("weight") * F.col("level"), F.col("most").cast("double")),
                ),
                DIGITS,
            ),
        )
        .withColumn(
            "whole",
            F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
            .otherwise(0).cast("long"),
        )
        .withColumn("remaining", F.col("target") - F.col("whole") * F.col("source_size"))
        .select("source", "source_size", "target", "whole", "remaining")
    )


def with_scale(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """Adds ``scale``: p is scale * size, 1 at most, over the documents of a source."""
    lengths = (
        sizes.where("size > 0")
        .groupBy("source", "size")
        .agg(F.count("*").alias("n"))
        .withColumnRenamed("source", "_source")
    )
    longer = Window.partitionBy("source").orderBy(F.desc("size"))
    longer = longer.rowsBetween(Window.unboundedPreceding, -1)
    wide = F.col("size").cast("decimal(18,0)")
    square = (wide * wide * F.col("n")).cast("decimal(38,0)")
    certain = F.coalesce(F.sum(F.col("size") * F.col("n")).over(longer), F.lit(0))
    squares = F.sum(square).over(Window.partitionBy("source")) - F.coalesce(
        F.sum(square).over(longer), F.lit(0)
    )
    scales = (
        lengths.join(targets, F.col("source").eqNullSafe(F.col("_source")))
        .withColumn("scale", (F.col("remaining") - certain) / squares.cast("double"))
        .where("scale * size <= 1")
        .groupBy("source")
        .agg(F.max_by("scale", "size").alias("scale"))
        .withColumnRenamed("source", "_source")
    )
    return (
        targets.join(scales, F.col("source").eqNullSafe(F.col("_source")), "left")
        .drop("_source")
        .fillna({"scale": 0.0})
    )


def _ranked(sizes: DataFrame, sources: DataFrame, key: str) -> DataFrame:
    """Documents with the columns of their source and their rank; null if never drawn."""
    digest = F.md5(F.concat_ws(":", F.col(key).cast("string"), F.col("copy").cast("string")))
    draw = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") + 0.5) / F.lit(float(2**52))
    p = F.col("scale") * F.col("size")
    odds = (F.col("u") / (1 - F.col("u"))) / (F.col("p") / (1 - F.col("p")))
    joined = sizes.withColumnRenamed("source", "_source").join(
        sources, F.col("source").eqNullSafe(F.col("_source"))
    )
    return (
        joined.withColumns({"u": draw, "p": p})
        .withColumn(
            "rank",
            F.when((F.col("size") == 0) | (F.col("p") <= 0), None)
            .when(F.col("p") >= 1, 0.0)
            .otherwise(odds),
        )
        .withColumn("z", F.col("rank") / (1 + F.col("rank")) * BINS)
        .withColumn("bin", F.floor("z"))
        .withColumn("finer", F.floor((F.col("z") - F.col("bin")) * BINS))
    )


def _at_cut(ranked: DataFrame, bin_column: str, words: Column) -> DataFrame:
    """For each source the bin in which ``words`` are reached, and the words before it."""
    order = Window.partitionBy("source").orderBy(bin_column)
    return (
        ranked.where(F.col("rank").isNotNull())
        .groupBy("source", bin_column)
        .agg(F.sum("size").alias("in_bin"), F.first(words).alias("words"))
        .withColumn("to_bin", F.sum("in_bin").over(order))
        .where("to_bin - in_bin < words and words <= to_bin")
        .select(
            F.col("source").alias("_at"),
            F.col(bin_column).alias(f"cut_{bin_column}"),
            (F.col("to_bin") - F.col("in_bin")).alias(f"to_{bin_column}"),
        )
    )


def _with(sources: DataFrame, cut: DataFrame) -> DataFrame:
    return sources.join(cut, F.col("source").eqNullSafe(F.col("_at")), "left").drop("_at")


def _described(docs: DataFrame, key: str, text: str, source: str, *more: Column) -> DataFrame:
    return docs.select(
        F.col(f"`{key}`").alias(key),
        F.col(f"`{source}`").cast("string").alias("source"),
        word_count(F.col(f"`{text}`")).alias("size"),
        *more,
    )


def _planned(
    docs: DataFrame,
    key: str,
    text: str,
    source: str,
    weights: Sequence[int],
    share: float,
    max_copies: int,
) -> tuple[DataFrame, DataFrame]:
    """Sizes, one row per document, and sources with all that decides a draw.

    Sizes are counted once and staged, and so is the table of sources (one row each),
    whose size Spark then knows when it joins it.
    """
    if key in ("source", "size", "copy", "rows", "row"):
        raise ValueError(f"the key column may not be called {key}")
    counted = _described(docs, key, text, source)
    numbered = counted.groupBy(key, "source", "size").agg(F.count("*").alias("rows"))
    numbered = numbered.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("rows"))))
    sizes = stage(numbered, "mix-sizes")

    sources = stage(source_targets(sizes, weights, share, max_copies), "mix-targets")
    sources = stage(with_scale(sizes, sources), "mix-scale")
    ranked = _ranked(sizes, sources, key)
    sources = stage(_with(sources, _at_cut(ranked, "bin", F.col("remaining"))), "mix-bins")

    ranked = _ranked(sizes, sources, key).where("bin = cut_bin")
    sources = stage(
        _with(sources, _at_cut(ranked, "finer", F.col("remaining") - F.col("to_bin"))),
        "mix-finer",
    )

    ranked = _ranked(sizes, sources, key).where("bin = cut_bin and finer = cut_finer")
    order = Window.partitionBy("source").orderBy("rank", key, "size", "copy")
    to_here = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0))
    last = F.struct("rank", key, "size", "copy")
    edge = (
        ranked.withColumn("to_here", F.col("to_bin") + F.col("to_finer") + to_here)
        .where("to_here - size / 2 <= remaining")
        .groupBy(F.col("source").alias("_at"))
        .agg(F.max(last).alias("edge"))
    )
    sources = stage(_with(sources, edge), "mix-edges")
    return sizes, sources


def _copies(sizes: DataFrame, sources: DataFrame, key: str) -> DataFrame:
    """Adds the columns of the source and ``copies``, how often each document is taken."""
    last = F.struct("rank", key, "size", "copy")
    drawn = (
        F.when(F.col("rank").isNull(), False)
        # no cut: nothing remains to be drawn
        .when(F.col("cut_bin").isNull() | F.col("cut_finer").isNull(), False)
        .when(F.col("bin") != F.col("cut_bin"), F.col("bin") < F.col("cut_bin"))
        .when(F.col("finer") != F.col("cut_finer"), F.col("finer") < F.col("cut_finer"))
        .otherwise(F.coalesce(last <= F.col("edge"), F.lit(False)))
    )
    copies = F.col("whole") + drawn.cast("long")
    return _ranked(sizes, sources, key).withColumn("copies", copies)


def mix_sources(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    max_copies: int = MAX_COPIES,
) -> DataFrame:
    """For every row: key, source, size, source_size, target, copies and taken words."""
    sizes, sources = _planned(docs, key, text, source, weights, share, max_copies)
    return _copies(sizes, sources, key).select(
        key,
        "source",
        "size",
        "source_size",
        "target",
        "copies",
        (F.col("copies") * F.col("size")).alias("taken"),
    )


def mixed(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    max_copies: int = MAX_COPIES,
) -> DataFrame:
    """The mix itself: rows of ``docs`` as often as they are taken.

    Rows alike in key, source and size share their copies: what does not divide goes to
    the first by the digest of the whole row.  Rows alike in all columns are one row with
    a count before they are shuffled, and texts are in no window.
    """
    sizes, sources = _planned(docs, key, text, source, weights, share, max_copies)
    alike = stage(
        _copies(sizes.where("rows > 1"), sources, key)
        .groupBy(F.col(key).alias("_key"), F.col("source").alias("_from"), F.col("size").alias("_size"))
        .agg(F.sum("copies").alias("_copies"), F.count("*").alias("_rows")),
        "mix-alike",
    )
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = _described(docs, key, text, source, whole.alias("row"), F.lit(1).alias("copy"))
    same = (
        F.col(key).eqNullSafe(F.col("_key"))
        & F.col("source").eqNullSafe(F.col("_from"))
        & (F.col("size") == F.col("_size"))
    )
    alone = _copies(rows.join(alike, same, "left_anti"), sources, key).select("row", "copies")

    group = ["_key", "_from", "_size", "_copies", "_rows"]
    repeated = stage(
        rows.join(alike, same)
        .withColumn("digest", F.md5(F.to_json("row")))
        .groupBy(*group, "digest")
        .agg(F.first("row").alias("row"), F.count("*").alias("times")),
        "mix-repeated",
    )
    before = Window.partitionBy("_key", "_from", "_size").orderBy("digest")
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    places = repeated.select(*group, "digest", "times").withColumn(
        "before", F.coalesce(F.sum("times").over(before), F.lit(0))
    )
    more = F.greatest(F.lit(0), F.least("times", F.col("_copies") % F.col("_rows") - F.col("before")))
    own = (F.floor(F.col("_copies") / F.col("_rows")) * F.col("times") + more).cast("long")
    places = places.select(
        F.col("_key").alias("k"), F.col("_from").alias("f"), F.col("_size").alias("s"),
        F.col("digest").alias("d"), own.alias("copies"),
    )
    here = (
        F.col("_key").eqNullSafe(F.col("k"))
        & F.col("_from").eqNullSafe(F.col("f"))
        & (F.col("_size") == F.col("s"))
        & (F.col("digest") == F.col("d"))
    )
    taken = alone.unionByName(repeated.join(places, here).select("row", "copies"))
    return (
        taken.where("copies > 0")
        .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
        .select("row.*")
    )
