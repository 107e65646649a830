import random
import re
from itertools import permutations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ringcast.llm import filter_audit
from ringcast.llm.filter_audit import audit_files, best_labels, mask_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")
COLUMNS = ("part filter_order step kept removed redundant unique_fails good_lost toxic_lost shapley").split()


def plain_mask(text):
    words = WORD.findall(text)
    return [
        len(words) < 50,
        100 * len(set(words)) < 65 * len(words),
        100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
        bool(re.search(r"[#$%&*|]", text)),
    ]


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet="abAB é漢🙂\n\t\x0b\x1c\x85\xa0#$%&*|.", max_size=150))
def test_masks_equal_the_rules(text):
    assert mask_of(text.encode()) == sum(bit << i for i, bit in enumerate(plain_mask(text)))


def brute(docs, labels):
    """The report, by applying each order to each row."""
    best = {}
    for k, quality, toxic in labels:
        good, bad = best.get(k, (0, 0))
        best[k] = max(good, quality == 1), max(bad, toxic == 1)
    least = {}
    for k, _, text in docs:
        if k is not None:
            least[text or ""] = min(k, least.get(text or "", k))
    rows = []
    for k, part, text in docs:
        text = text or ""
        repeated = k is not None and k > least[text]
        rows.append((part or "", [*plain_mask(text), repeated], best.get(k, (0, 0)) if k is not None else (0, 0)))
    out, removed_of = [], {}
    for part in {p for p, *_ in rows}:
        own = [r for r in rows if r[0] == part]
        for order in permutations(range(5)):
            for step, f in enumerate(order):
                earlier = [r for r in own if any(r[1][g] for g in order[:step])]
                here = [r for r in own if r[1][f] and r not in earlier]
                gone = [r for r in own if any(r[1][g] for g in order[: step + 1])]
                removed = sum(r[1][f] and not any(r[1][g] for g in order[:step]) for r in own)
                removed_of[part, f] = removed_of.get((part, f), 0) + removed
                out.append([
                    part, "".join("ABCDE"[g] for g in order), step + 1, len(own) - len(gone), removed,
                    sum(r[1][f] for r in earlier), sum(r[1][f] and sum(r[1]) == 1 for r in own),
                    sum(r[2][0] for r in here), sum(r[2][1] for r in here), f,
                ])
    return sorted((*r[:-1], removed_of[r[0], r[-1]]) for r in out)


def table(spark, rows, path, mode="overwrite"):
    made = [(k, p, t, "x", 1, b"d") for k, p, t in rows]
    docs = spark.createDataFrame(
        made, "doc_id long, source string, text string, part string, mask int, digest binary"
    )
    docs.coalesce(1).write.mode(mode).parquet(path)


def rows_of(report):
    return sorted(tuple(r) for r in report.select(COLUMNS).collect())


def label_frame(spark, rows):
    return best_labels(spark.createDataFrame(rows, "doc_id long, quality int, toxic int"))


def test_equals_brute_force_as_smaller_ids_arrive_later(spark, tmp_path):
    rng = random.Random(3)
    long = " ".join(f"w{i}" for i in range(60))
    texts = ["short", "", None, long, long + " #", "THE " + long[:20], "a b " * 40, "A" * 300, "x" * 100_000]
    docs = [(rng.randint(-20, 40), rng.choice(["s1", "s2", None, ""]), rng.choice(texts)) for _ in range(150)]
    docs += [(None, "s1", "short"), (None, None, long), (5, "s1", long), (5, "s2", long), (5, "s1", long)]
    docs += [(-100, "s9", t) for t in texts]  # the least ids come last
    labels = [(i % 45 - 20, i % 2, i % 3 == 0) for i in range(90)]
    labels = [(k, int(q), int(t)) for k, q, t in labels] + [(None, 1, 1), (7, None, None)]
    path = str(tmp_path / "documents.parquet")
    for k in range(0, len(docs), 40):
        table(spark, docs[k : k + 40], path, "append")
    made = audit_files(spark, path, label_frame(spark, labels), batches=5, buckets=7)
    assert rows_of(made) == brute(docs, labels)


def test_new_files_correct_the_counters(spark, tmp_path, monkeypatch):
    """A second run reads the new files alone; merging within a task is cut short."""
    monkeypatch.setattr(filter_audit, "MERGED", 3)
    path, folder = str(tmp_path / "documents.parquet"), str(tmp_path / "state")
    first = [(i, "s", f"text {i % 6}") for i in range(10, 40)]
    second = [(i, "t", f"text {i}") for i in range(10)]
    labels = [(i, 1, i % 2) for i in range(40)]
    frame = label_frame(spark, labels)
    table(spark, first, path)
    assert rows_of(audit_files(spark, path, frame, folder=folder)) == brute(first, labels)
    table(spark, second, path, "append")
    assert rows_of(audit_files(spark, path, frame, folder=folder)) == brute(first + second, labels)


@pytest.mark.parametrize("as_file", [True, False])
def test_an_empty_table(spark, tmp_path, as_file):
    path = str(tmp_path / "documents.parquet")
    table(spark, [], path)
    if as_file:
        (path,) = map(str, (tmp_path / "documents.parquet").glob("part-*.parquet"))
    assert audit_files(spark, path, label_frame(spark, [])).count() == 0
