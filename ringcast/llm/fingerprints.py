"""Document fingerprints by winnowing, in DataFrame functions alone.

Every run of ``k`` bytes of the UTF-8 text is hashed; of every ``w`` neighbouring hashes
the least is chosen, the rightmost of equal ones, and what is chosen is kept with its
position.  So a passage of ``k + w - 1`` bytes that two texts share leaves a common hash,
and positions tell where.  A text shorter than ``k`` bytes is one run, and one with fewer
than ``w`` runs is one window; an empty or null text has no fingerprint.

A chosen hash is one number: 36 bits of hash above 27 bits of position, counted from the
top, so that the least number is the rightmost least hash.  Texts of 2^27 bytes and over
are refused with an error rather than cut.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ringcast.session import stage

K, WINDOW = 9, 8
HASH_BITS, PLACE_BITS = 36, 27
_TOP = (1 << PLACE_BITS) - 1


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _least_of(runs: Column, w: int) -> Column:
    """The least of every ``w`` neighbours, by doubling the reach; of all if fewer."""

    def widened(step):
        # get() beyond the end is null, which least() passes over
        return lambda v: F.transform(v, lambda x, i: F.least(x, F.get(v, i + step)))

    least, reach = runs, 1
    while reach < w:
        step = min(reach, w - reach)
        least, reach = _let(least, widened(step)), reach + step
    return _let(least, lambda v: F.slice(v, 1, F.greatest(F.size(v) - (w - 1), F.lit(1))))


def winnow(text: Column, k: int = K, w: int = WINDOW) -> Column:
    """Chosen hashes of a text with their positions, in order, as numbers."""
    return _winnow_bytes(F.coalesce(text, F.lit("")).cast("binary"), k, w)


def _winnow_bytes(raw: Column, k: int, w: int) -> Column:
    def run_hash(raw, i):
        kept = F.xxhash64(F.substring(raw, i, F.lit(k))).bitwiseAND((1 << HASH_BITS) - 1)
        return F.shiftleft(kept, PLACE_BITS).bitwiseOR(F.lit(_TOP).cast("long") - i)

    def of_bytes(raw):
        starts = F.sequence(F.lit(1), F.greatest(F.octet_length(raw) - (k - 1), F.lit(1)))
        least = _least_of(F.transform(starts, lambda i: run_hash(raw, i)), w)
        return (
            F.when(F.octet_length(raw) > _TOP, F.raise_error(F.lit("text of 2^27 bytes or more")))
            .when(F.octet_length(raw) > 0, F.array_distinct(least))
            .otherwise(F.array().cast("array<bigint>"))
        )

    return _let(raw, of_bytes)


def _place(chosen: Column) -> Column:
    """First byte, from 1, of a chosen run."""
    return F.lit(_TOP) - chosen.bitwiseAND(_TOP)


def winnow_joined(
    a: Column, chosen_a: Column, b: Column, chosen_b: Column, k: int = K, w: int = WINDOW
) -> Column:
    """Chosen hashes of ``a`` and ``b`` joined, without positions, in order of appearance.

    ``a`` and ``b`` are beginnings of texts whose ``winnow`` is ``chosen_a`` and
    ``chosen_b``.  Windows inside one of them choose what they choose in its text; as places
    never go back from one window to the next, that is all up to the choice of the last
    such window.  Only windows over the border are worked out, and short parts whole.
    """
    span = k + w - 1  # bytes of a window
    raw_a, raw_b = a.cast("binary"), b.cast("binary")
    size_a, size_b = F.octet_length(raw_a), F.octet_length(raw_b)

    def inside(raw, size, chosen):
        last = F.element_at(_winnow_bytes(F.substring(raw, size - (span - 1), F.lit(span)), k, w), 1)
        bound = _place(last) + (size - span)
        return _let(bound, lambda until: F.filter(chosen, lambda x: _place(x) <= until))

    over = F.concat(
        F.substring(raw_a, size_a - (span - 2), F.lit(span - 1)),
        F.substring(raw_b, F.lit(1), F.lit(span - 1)),
    )
    parts = F.concat(
        inside(raw_a, size_a, chosen_a), _winnow_bytes(over, k, w), inside(raw_b, size_b, chosen_b)
    )
    long = (size_a >= span) & (size_b >= span) & (size_a + size_b <= _TOP)
    return chosen_hashes(F.when(long, parts).otherwise(_winnow_bytes(F.concat(raw_a, raw_b), k, w)))


def chosen_hashes(chosen: Column) -> Column:
    """The set of hashes of a fingerprint, without positions, in order of appearance."""
    return F.array_distinct(F.transform(chosen, lambda x: F.shiftright(x, PLACE_BITS)))


def positions(chosen: Column) -> Column:
    """First byte, from 0, of each chosen run."""
    return F.transform(chosen, lambda x: (F.lit(_TOP) - x.bitwiseAND(_TOP)).cast("long") - 1)


def digest(hashes: Column) -> Column:
    return F.sha2(F.concat_ws(",", hashes.cast("array<string>")), 256)


def likeness(a: Column, b: Column) -> Column:
    """Share of hashes in common, from 0 to 1; two empty fingerprints are alike."""
    both = F.size(F.array_intersect(a, b))
    either = F.size(a) + F.size(b) - both
    return F.when(either == 0, 1.0).otherwise(both / either)


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row's key with its chosen hashes and their byte positions."""
    chosen = winnow(F.col(f"`{text}`"))
    made = docs.select(F.col(f"`{key}`").alias(key), chosen.alias("_chosen"))
    return made.select(
        key,
        F.transform("_chosen", lambda x: F.shiftright(x, PLACE_BITS)).alias("hashes"),
        positions(F.col("_chosen")).alias("positions"),
    )


CELLS = 512  # of the quantiles of the key
BUCKETS_PER_PARTITION = 4


def with_next(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Key and text of every row with the text of the next row by key, ``next_text``.

    Rows of equal keys follow by text, null keys come first, and after the last row comes
    the first.  Rows are dealt to buckets, each a range of keys; the ranges come from the
    key's quantiles, so buckets hold about the same number of rows.  The first row of a
    bucket is dealt to the bucket before as well, where it ends the order.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    number = F.coalesce(F.col("key").cast("long"), F.lit(-(1 << 63)))
    shares = [i / CELLS for i in range(CELLS)]
    bounds = rows.agg(F.percentile_approx(number, shares, 10_000)).first()[0]
    if bounds is None:
        fixed = {"k": F.lit(0), "bucket": F.lit(0), "guest": F.lit(0)}
        return rows.withColumns(fixed | {"next_text": F.col("text")})
    bounds = sorted(set(bounds))
    edges = F.array(*[F.lit(b).cast("long") for b in bounds])
    n_buckets = BUCKETS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    low, high = F.get(edges, F.col("cell") - 1), F.get(edges, F.col("cell"))
    part = (F.col("k").cast("double") - low) / F.greatest(high.cast("double") - low, F.lit(1.0))
    # of the last range only the start is known; it is one of CELLS, and is spread by
    # the width of the range before
    last = (F.col("k").cast("double") - low) / F.lit(
        max(1.0, float(bounds[-1]) - float(bounds[-2])) if len(bounds) > 1 else 1.0
    )
    part = F.least(F.coalesce(part, last), F.lit(1.0))
    at = (F.col("cell") - 1 + part) / len(bounds)
    bucket = F.least(F.floor(at * n_buckets), F.lit(n_buckets - 1)).cast("int")

    def dealt(df, *columns):
        cell = F.size(F.filter(edges, lambda b: b <= F.col("k")))
        return (
            df.withColumn("k", number)
            .withColumn("cell", F.greatest(F.lit(1), cell))
            .withColumn("bucket", bucket)
            .select("k", "bucket", *columns)
        )

    heads = dealt(rows.select("key")).groupBy("bucket").agg(F.min("k").alias("head"))
    order = Window.orderBy("bucket")  # over one row per bucket
    heads = heads.select(
        F.col("head"),
        F.coalesce(F.lag("bucket").over(order), F.max("bucket").over(Window.partitionBy())).alias(
            "also"
        ),
    )
    heads = stage(heads, "fingerprint-heads")
    places = F.when(
        F.col("also").isNull(), F.array(F.struct(F.col("bucket"), F.lit(0).alias("guest")))
    ).otherwise(
        F.array(
            F.struct(F.col("bucket"), F.lit(0).alias("guest")),
            F.struct(F.col("also").alias("bucket"), F.lit(1).alias("guest")),
        )
    )
    spread = (
        dealt(rows, "key", "text")
        .join(heads, F.col("k") == F.col("head"), "left")
        .withColumn("place", F.explode(places))
        .select("key", "text", "k", "place.bucket", "place.guest")
    )
    follows = Window.partitionBy("bucket").orderBy("guest", "k", "text")
    return spread.withColumn("next_text", F.lead("text").over(follows))


def compare_edited(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every row and of its edited text, and how alike they are.

    The edited text has its last half replaced by as much of the next row's start, or all
    of it; see ``with_next`` for the order.  ``near_next`` is the likeness to the next
    row.  Every column but the key is made anew, whatever ``docs`` has.
    """
    rows = with_next(docs, key, text)
    own = F.coalesce(F.col("text"), F.lit(""))
    following = F.coalesce(F.col("next_text"), F.lit(""))
    n = F.char_length(own)
    half = F.floor(n / 2).cast("int")
    kept, taken = F.substring(own, F.lit(1), n - half), F.substring(following, F.lit(1), half)
    follows = Window.partitionBy("bucket").orderBy("guest", "k", "text")
    return (
        rows.withColumn("chosen", winnow(F.col("text")))
        .withColumn("next_chosen", F.lead("chosen").over(follows))
        .where("guest = 0")
        .withColumns({"kept": kept, "taken": taken})
        .withColumns({
            "own": chosen_hashes(F.col("chosen")),
            "next": chosen_hashes(F.col("next_chosen")),
            "hashes": winnow_joined(
                F.col("kept"), F.col("chosen"), F.col("taken"), F.col("next_chosen")
            ),
            "edited": F.concat("kept", "taken"),
        })
        .select(
            F.col("key").alias(key),
            n.cast("long").alias("n_chars"),
            F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
            digest(F.col("own")).alias("fingerprint"),
            digest(F.col("hashes")).alias("edited_fingerprint"),
            likeness(F.col("own"), F.col("hashes")).alias("near_edited"),
            likeness(F.col("own"), F.col("next")).alias("near_next"),
        )
    )
