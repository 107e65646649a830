from collections import Counter, defaultdict

import duckdb
import pytest

from ringcast.llm import oracle
from ringcast.llm.mixing import mix_sources, mixed

SCHEMA = "doc_id long, text string, source string, size string, copies int, rank int"


def row(i, n, source):
    return (i, " ".join(f"w{j}" for j in range(n)) if n is not None else None, source, "s", 9, 9)


def wanted_targets(sizes):
    """Targets by sharing the excess again and again, as stated."""
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    left, out, open_ = 1.5 * sum(sizes.values()), {}, list(order)
    while open_:
        total = sum(weight[s] for s in open_)
        full = [s for s in open_ if left * weight[s] / total >= 2 * sizes[s]]
        if not full:
            return out | {s: left * weight[s] / total for s in open_}
        for s in full:
            out[s] = 2 * sizes[s]
            left -= 2 * sizes[s]
            open_.remove(s)
    return out


def checked(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = mix_sources(docs).collect()
    again = mix_sources(docs.repartition(3)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    assert Counter((r.doc_id, r.source, r.size) for r in got) == Counter(
        (i, s, len((t or "").split())) for i, t, s, *_ in rows
    )
    sizes, taken, most, target = defaultdict(int), defaultdict(int), defaultdict(int), {}
    for r in got:
        assert 0 <= r.taken == r.copies * r.size and r.copies <= 2
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        most[r.source] = max(most[r.source], r.size)
        target[r.source] = r.target
    wanted = wanted_targets(dict(sizes))
    for s in sizes:
        assert target[s] == pytest.approx(wanted[s], abs=1e-5)
        assert abs(taken[s] - target[s]) <= most[s] / 2 + 1e-5
        assert all(r.source_size == sizes[s] for r in got if r.source == s)
    return docs, got


def test_uneven_sources_nulls_and_empty_texts(spark):
    rows = [row(i, 1 + i % 40, "hot") for i in range(400)]
    rows += [row(1000 + i, 5, "even") for i in range(60)]
    rows += [row(2000 + i, 300 if i == 0 else 2, None) for i in range(30)]
    rows += [row(3000, None, "void"), row(3001, 0, "void"), row(None, 7, "hot"), row(None, 7, "é")]
    docs, got = checked(spark, rows)
    times = Counter((r.doc_id, r.text, r.source) for r in mixed(docs).collect())
    assert sum(times.values()) == sum(r.copies for r in got if r.size) + sum(
        r.copies for r in got if not r.size
    )
    copies = Counter()
    for r in got:
        copies[(r.doc_id, r.source)] += r.copies
    found = Counter()
    for (i, _, s), n in times.items():
        found[(i, s)] += n
    assert found == +copies
    assert mixed(docs).columns == docs.columns


def test_repeated_rows_are_draws_of_their_own(spark):
    rows = [row(1, 10, "a")] * 90 + [row(2, 10, "b")] * 30 + [row(3, 10, "c")] * 30
    docs, got = checked(spark, rows)
    assert mixed(docs).count() == sum(r.copies for r in got)


def test_one_source_and_empty_table(spark):
    checked(spark, [row(i, 3, "only") for i in range(50)])
    assert mix_sources(spark.createDataFrame([], SCHEMA)).count() == 0
    assert mixed(spark.createDataFrame([], SCHEMA)).count() == 0


def test_matches_sql_on_uneven_sources(spark):
    rows = [row(i, 1 + (i * i) % 97, f"s{i % 3}" if i % 7 else None) for i in range(500)]
    docs = spark.createDataFrame(rows, SCHEMA).select("doc_id", "text", "source")
    documents = docs.toPandas()  # noqa: F841  read by name below
    connection = duckdb.connect()
    connection.register("documents", documents)
    sql = connection.execute(oracle.MIXING)
    names = [d[0] for d in sql.description]
    wanted = sorted(map(str, sql.fetchall()))
    assert sorted(str(tuple(r[n] for n in names)) for r in mix_sources(docs).collect()) == wanted
