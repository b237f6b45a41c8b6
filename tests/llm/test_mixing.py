import re
from collections import defaultdict

import duckdb
import pytest

from viewtide.llm import mixing
from viewtide.llm.catalog import QUERIES, SQL
from viewtide.session import SCOPES, scratch_scope
from workload.check import sorted_rows


def filled(sizes, weights, epochs=3):
    """Targets by reshaping the excess again and again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    full, total = set(), sum(sizes.values())
    while True:
        left = total - sum(epochs * sizes[s] for s in full)
        open_ = [s for s in sizes if s not in full]
        target = {s: left * weight[s] / sum(weight[o] for o in open_) for s in open_}
        above = {s for s in open_ if target[s] > epochs * sizes[s]}
        if not above:
            return target | {s: epochs * sizes[s] for s in full}
        full |= above


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1000, "c": 1, "d": 5, None: 300}, {"a": 7}, {"x": 0, "y": 9}, {c: 2 ** i for i, c in enumerate("abcdefghij")}])
def test_targets(session, sizes):
    rows = session.createDataFrame([(s, v) for s, v in sizes.items()], "source string, size long")
    found = {r.source: r for r in mixing.shares(rows).collect()}
    expected = filled(sizes, (1, 2, 3))
    assert set(found) == set(sizes)
    for source, row in found.items():
        assert row.target == pytest.approx(expected[source]) and row.target <= 3 * sizes[source]
        assert row.whole * sizes[source] + row.extra == pytest.approx(row.target)


def test_rows(documents):
    rows = [(i, "w " * (i % 11 + 1), "en", f"s{i % 3}") for i in range(600)]
    rows += [(700, None, None, None), (701, " one two ", None, None), (702, "x y", "en", "S"), (702, "x y", "en", "S"), (None, "p q r", "en", "s1"), (None, "p q r", "en", "s1")]
    df = documents(rows)
    found = mixing.mix(df).collect()
    assert len(found) == len(rows)
    taken, targets, longest = defaultdict(int), {}, defaultdict(int)
    source = {r[0]: r[3] for r in rows if r[0] is not None}
    for row in found:
        assert 0 <= row.taken <= 3 * row.size and (row.size == 0 or row.taken % row.size == 0)
        name = source.get(row.doc_id, "s1")
        taken[name] += row.taken
        targets[name] = row.target
        longest[name] = max(longest[name], row.size)
    for name, target in targets.items():
        assert abs(taken[name] - target) <= longest[name] / 2 + 1e-6
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.size, r.taken)
    assert sorted(found, key=key) == sorted(mixing.mix(df.repartition(5)).collect(), key=key)
    repeated = mixing.mixed(df)
    assert repeated.columns == df.columns
    assert sum(len((r.text or "").split()) for r in repeated.collect()) == sum(taken.values())


def test_words_are_not_listed(session):
    texts = ["", " ", "a", " a", "a\t", "  ab  cd ", "\t\n\x0b\x0c\r", "x\xa0y \x85 z", "é\u0301 😀 😀😀", "$1 \\ $", "a\x1fb\0 c", "w" * 9000, "w \n" * 9000]
    found = session.createDataFrame([(t,) for t in texts], "text string").select("text", mixing.words("text").alias("n"))
    for row in found.collect():
        assert row.n == len(re.findall(r"[^\x20\x09-\x0D]+", row.text))
    assert "regexp_extract_all" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_few_tables_are_written(documents):
    df = documents([(i, "a b", "en", f"s{i % 5}") for i in range(20)])
    with scratch_scope(df.sparkSession):
        assert len(mixing.mix(df).collect()) == 20
        # Sizes, totals, their order, two running totals, their end, the rows in order.
        assert len(SCOPES[-1]) == 7


def test_empty(documents):
    none = documents([]).limit(0)
    assert mixing.mix(none).collect() == [] and mixing.mixed(none).collect() == []


@pytest.mark.parametrize("name", ["op2_mixing", "op10_multiindex"])
def test_queries_against_sql(session, folder, name):
    database = duckdb.connect()
    for table in ("documents", "embeddings"):
        database.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    df = QUERIES[name](session, folder)
    result = database.execute(SQL[name])
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert sorted_rows(df.columns, df.collect()) == sorted_rows(columns, result.fetchall())
