import hashlib
import random
import re

import pytest

from ringcast.llm.decontamination import find_items, item_digests

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items, window):
    """Rows of the query, by comparing each window with each place of each text."""
    out = []
    for key, text in docs:
        w, hit, names = words(text), set(), set()
        for name, item in items:
            own = words(item)
            n = min(window, len(own))
            for i in range(len(own) - n + 1) if own else ():
                for j in range(len(w) - n + 1):
                    if w[j : j + n] == own[i : i + n]:
                        hit.update(range(j, j + n))
                        names |= {str(name)} if name is not None else set()
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        out.append((key, len(w), len(hit), len(names), digest, bool(hit)))
    return sorted(out, key=str)


def frames(spark, docs, items):
    # extra columns whose names the operator uses inside
    made = [(k, t, "x", 1, 2, [3]) for k, t in docs]
    d = spark.createDataFrame(
        made, "doc_id long, text string, token string, n_words int, _row int, around array<int>"
    )
    i = spark.createDataFrame([(k, t, 0) for k, t in items], "item_id long, text string, words int")
    return d, i


def check(spark, docs, items, window=10, shingle=3):
    d, i = frames(spark, docs, items)
    got = item_digests(d, i, window=window, shingle=shingle)
    assert got.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs, items, window)


@pytest.mark.parametrize("seed,window,shingle", [(1, 10, 3), (2, 4, 3), (3, 3, 1), (4, 2, 3)])
def test_equals_brute_force_on_few_words(spark, seed, window, shingle):
    rng = random.Random(seed)
    vocabulary = ["a", "B", "cé", "9", "漢", "the"]

    def text(longest):
        return rng.choice([" ", ", ", "\n"]).join(rng.choices(vocabulary, k=rng.randint(0, longest)))

    docs = [(i, text(60)) for i in range(40)]
    items = [(i % 15, text(14)) for i in range(20)]
    for i in range(0, 40, 3):  # whole items within documents
        docs[i] = (i, f"{docs[i][1]} {items[i % 20][1]} {text(5)}")
    check(spark, docs, items, window, shingle)


def test_nulls_ties_repeats_short_items_and_long_texts(spark):
    passage = " ".join(f"w{i}" for i in range(25))
    docs = [
        (1, None), (2, ""), (3, " .;- "), (4, f"x {passage} y"), (4, f"x {passage} y"), (4, "other"),
        (None, passage.upper()), (5, " ".join(f"w{i}" for i in range(9))), (6, "alone"),
        (7, "z " * 300_000 + passage + " z" * 10), (8, "w3 " * 200_000), (9, "q" * 400_000),
    ]
    items = [(1, passage), (1, passage), (10, passage), (None, passage), (2, None), (3, ""), (4, "alone"),
             (5, "two words"), (9, "z z z z z z z z z z"), (6, "q" * 400_000)]
    check(spark, docs, items)


def test_empty_tables(spark):
    docs, items = frames(spark, [(1, "a b c")], [(1, "a b c")])
    assert item_digests(docs.limit(0), items).count() == 0
    (row,) = item_digests(docs, items.limit(0)).collect()
    assert (row.n_words, row.n_hit, row.contaminated) == (3, 0, False)


def test_spans_lie_where_the_passage_is(spark):
    passage = " ".join(f"w{i}" for i in range(12))
    docs, items = frames(spark, [(1, f"a b {passage} c")], [(1, passage)])
    (row,) = find_items(docs, items).collect()
    assert [tuple(s) for s in row.spans] == [(2, 10), (3, 10), (4, 10)]
    assert (row.n_hit, row["items"]) == (12, ["1"])


def test_joins_go_by_equality(spark):
    docs, items = frames(spark, [(1, "a b c")], [(1, "a b c")])
    plan = item_digests(docs, items)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
