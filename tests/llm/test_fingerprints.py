import hashlib

from pyspark.sql import functions as F

from ringcast.llm.fingerprints import K, WINDOW, compare_edited, fingerprints, with_next

MASK = (1 << 36) - 1


def brute_choices(hashes):
    """Rightmost least hash of every window: {(position, hash)}."""
    out = set()
    for i in range(max(1, len(hashes) - WINDOW + 1)):
        window = hashes[i : i + WINDOW]
        least = min(window)
        out.add((i + max(j for j, h in enumerate(window) if h == least), least))
    return out


def run_hashes(spark, texts):
    rows = []
    for n, t in enumerate(texts):
        raw = (t or "").encode()
        runs = [raw[i : i + K] for i in range(max(1, len(raw) - K + 1))] if raw else []
        rows += [(n, i, bytearray(r)) for i, r in enumerate(runs)]
    got = spark.createDataFrame(rows, "n int, i int, r binary").select("n", "i", F.xxhash64("r").alias("h"))
    out = [[] for _ in texts]
    for r in sorted(got.collect()):
        out[r.n].append(r.h & MASK)
    return out


TEXTS = [
    "the cat sat on the mat and the cat sat on the mat again",
    "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa",
    "größe und maß, über allem éèê — 漢字",
    "short",
    "ninebytes",
    "twelve bytes",
    "",
    None,
    "x" * 3000 + "y" + "x" * 3000,
]


def test_choices_match_brute_force(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    hashes = run_hashes(spark, TEXTS)
    for r in fingerprints(docs).collect():
        got = set(zip(r.positions, r.hashes))
        assert len(got) == len(r.hashes)
        assert got == (brute_choices(hashes[r.doc_id]) if hashes[r.doc_id] else set())


def brute_compare(spark, rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    edited = []
    for (_, t), (_, after) in zip(rows, rows[1:] + rows[:1]):
        t, after = t or "", after or ""
        half = len(t) // 2
        edited.append(t[: len(t) - half] + after[:half])
    hashes = run_hashes(spark, [t for _, t in rows] + edited)
    sets = [{h for _, h in brute_choices(x)} if x else set() for x in hashes]
    own, changed = sets[: len(rows)], sets[len(rows) :]

    def near(a, b):
        return round(len(a & b) / len(a | b), 9) if a | b else 1.0

    return sorted(
        (str(d), len(t or ""), hashlib.sha256(e.encode()).hexdigest(), near(o, c), near(o, x))
        for (d, t), e, o, c, x in zip(rows, edited, own, changed, own[1:] + own[:1])
    )


def compared(docs):
    return sorted(
        (str(r.doc_id), r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9))
        for r in compare_edited(docs).collect()
    )


def test_small_rows_match_brute_force(spark):
    rows = [(i * 7 % 9, t) for i, t in enumerate(TEXTS)] + [(3, "three again"), (None, "no id")]
    docs = spark.createDataFrame(
        [(d, t, 1, "k") for d, t in rows], "doc_id long, text string, bucket int, k string"
    )
    assert compared(docs) == brute_compare(spark, rows)
    assert compare_edited(docs.limit(0)).count() == 0
    one = spark.createDataFrame([(5, "a single row of some words")], "doc_id long, text string")
    assert compared(one) == brute_compare(spark, [(5, "a single row of some words")])


def test_repeated_rows(spark):
    rows = [(1, "the same row twice over")] * 4 + [(2, "another")] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert compared(docs) == brute_compare(spark, rows)


def test_whole_table_matches_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert compared(docs) == brute_compare(spark, rows)


def test_next_row_over_uneven_keys(spark):
    ids = [1, 2, 3, 10**15, 10**15 + 1, -5, 7 * 10**17] + list(range(100, 400))
    docs = spark.createDataFrame([(i, f"t{i}") for i in ids], "doc_id long, text string")
    got = with_next(docs, "doc_id", "text").where("guest = 0")
    order = sorted(ids)
    after = dict(zip(order, order[1:] + order[:1]))
    assert {r.key: r.next_text for r in got.collect()} == {i: f"t{after[i]}" for i in ids}


def test_equal_texts_have_equal_fingerprints(spark):
    docs = spark.createDataFrame(
        [(i, "some words that are the same" if i % 2 else f"other {i}") for i in range(20)],
        "doc_id long, text string",
    )
    prints = {}
    for r in compare_edited(docs).join(docs, "doc_id").collect():
        assert prints.setdefault(r.text, r.fingerprint) == r.fingerprint
    assert len(set(prints.values())) == len(prints)


def test_joined_beginnings_choose_what_the_whole_text_chooses(spark):
    import random

    from ringcast.llm.fingerprints import chosen_hashes, winnow, winnow_joined

    pick = random.Random(4)
    rows = []
    for size in [0, 1, 8, 15, 16, 17, 30, 31, 90, 400]:
        for letters in ("ab", "abcdefgh é€", "a"):
            a, b = ("".join(pick.choices(letters, k=pick.choice([size, 16, 40]))) for _ in "ab")
            rows.append((a, b, pick.randint(0, len(a)), pick.randint(0, len(b))))
            rows.append((a, b, len(a), len(b)))
    df = spark.createDataFrame(rows, "a string, b string, n int, m int").selectExpr(
        "*", "substring(a, 1, n) as x", "substring(b, 1, m) as y"
    )
    got = df.select(
        winnow_joined(F.col("x"), winnow(F.col("a")), F.col("y"), winnow(F.col("b"))).alias("got"),
        chosen_hashes(winnow(F.concat("x", "y"))).alias("wanted"),
    )
    assert all(r.got == r.wanted for r in got.collect())
