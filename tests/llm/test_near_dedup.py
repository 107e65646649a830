import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ringcast.llm.near_dedup import (
    SIMILARITY,
    SKETCH,
    _cell,
    components,
    log_weights,
    near_classes,
    near_distinct,
    similarity,
    weighted_sets,
    weights_of,
)
from ringcast.llm.texts import Texts


def brute_classes(rows):
    """Least key of each row's component under all pairs of equal or similar texts."""
    texts = [t or "" for _, t in rows]
    of, hashes, times = weighted_sets(Texts.of(pa.array(texts)))
    logs = log_weights(np.bincount(_cell(hashes), minlength=SKETCH), len(np.unique(of)))
    weight = weights_of(hashes, times, logs)
    sets = [(hashes[of == i], weight[of == i]) for i in range(len(rows))]
    raw = [h.tobytes() + w.tobytes() for h, w in sets]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if len(sets[i][0]) and len(sets[j][0]):
                if texts[i] == texts[j] or similarity(raw[i], raw[j]) >= SIMILARITY:
                    parent[root(i)] = root(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        r = root(i)
        if key is not None:
            least[r] = min(key, least.get(r, key))
    return sorted(
        ((key, least.get(root(i)) if len(sets[i][0]) else key) for i, (key, _) in enumerate(rows)),
        key=str,
    )


def found(docs):
    return sorted(((r.doc_id, r.class_id) for r in near_classes(docs).collect()), key=str)


def test_whole_table_matches_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert found(docs) == brute_classes(rows)


def edited(words, share, pick):
    return " ".join(w if pick.random() > share else f"new{pick.random()}" for w in words)


def test_group_of_many_degrees_matches_brute_force(spark):
    pick = random.Random(3)
    base = [f"w{pick.random()}" for _ in range(120)]
    texts = [edited(base, s, pick) for s in [0.0, 0.01, 0.02, 0.03, 0.05, 0.08, 0.15] * 12]
    texts += [texts[3]] * 5 + [None, "", " \n ", "a b", "a b", "a b c"]
    rows = list(enumerate(texts)) + [(None, "a b"), (None, "x y z"), (7, texts[7])]
    pick.shuffle(rows)
    docs = spark.createDataFrame(
        [(k, t, 1, "n") for k, t in rows], "doc_id long, text string, bucket int, node string"
    )
    assert found(docs) == brute_classes(rows)
    kept = near_distinct(docs)
    assert kept.columns == docs.columns
    wanted = {c for k, c in brute_classes(rows) if c is not None}
    got = [r.doc_id for r in kept.collect()]
    assert sorted(x for x in got if x is not None) == sorted(wanted)
    assert got.count(None) == 1  # of the class without any key


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert found(docs) == []
    assert near_distinct(docs).count() == 0


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)]
    edges += [(200, 201), (202, 201), (300, 300)]
    got = components(spark.createDataFrame(edges, "a long, b long"))
    roots = {r.node: r.root for r in got.collect()}
    assert roots == (
        {i: 0 for i in range(41)} | {i: 100 for i in range(100, 140)}
        | {200: 200, 201: 200, 202: 200}
    )


def test_samples_agree_as_often_as_the_sets_are_similar():
    from ringcast.llm.near_dedup import samples

    pick = np.random.default_rng(5)
    hits, likeness = [], []
    for _ in range(60):
        h = np.unique(pick.integers(0, 2**63, 260).astype(np.uint64))
        w = pick.choice([1.0, 1.5, 3.0], len(h)).astype(np.float32)
        a, b = pick.random(len(h)) < 0.9, pick.random(len(h)) < 0.9
        drawn = samples(h[a], np.log(w[a])), samples(h[b], np.log(w[b]))
        hits.append((drawn[0] == drawn[1]).mean())
        likeness.append(similarity(*(h[x].tobytes() + w[x].tobytes() for x in (a, b))))
    assert abs(np.mean(hits) - np.mean(likeness)) < 0.03
