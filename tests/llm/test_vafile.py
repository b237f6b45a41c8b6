import hashlib
import math

import duckdb
import numpy as np
import pytest

from viewtide.llm import vafile
from viewtide.llm.catalog import QUERIES, SQL
from workload.check import sorted_rows

SCHEMA = "vec_id long, embedding array<double>, label int, vector string, number int, cluster string"


def make(session, rows):
    return session.createDataFrame([(i, v, 1, "v", 2, "c") for i, v in rows], SCHEMA).repartition(3)


def plain(rows, count, rounds, dims):
    """The same clustering with whole numbers, one vector after the other."""
    kept = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    digest = lambda i: "z" if i is None else hashlib.sha256(f"2:{i}".encode()).hexdigest()
    centroids = [v for _, v in sorted(kept, key=lambda r: (digest(r[0]), r[1]))[:count]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centroids))

    for _ in range(rounds):
        members = [[] for _ in centroids]
        for _, v in kept:
            members[nearest(v)[1]].append(v)
        centroids = [[sum(c) // len(m) for c in zip(*m)] if m else old for m, old in zip(members, centroids)]
    found = [(i, *nearest(v)[::-1]) for i, v in kept]
    total = sum(d for _, _, d in found)
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return [(i, k, d, sum(g for _, o, g in found if o == k), total, names[k]) for i, k, d in found]


def check(session, rows, count, rounds, dims):
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    found = [tuple(r) for r in vafile.clusters(make(session, rows), count, rounds, dims).collect()]
    assert sorted(found, key=key) == sorted(plain(rows, count, rounds, dims), key=key)


def test_against_plain(session):
    """Clusters, ties on a coarse grid, one vector with a third of all rows, and rows that take no part."""
    draw = np.random.default_rng(3)
    rows = [(i, (draw.normal(size=4) + 3 * (i % 5)).tolist()) for i in range(300)]
    rows += [(1000 + i, (draw.integers(-2, 3, 4) / 2).tolist()) for i in range(200)]
    rows += [(2000 + i, [0.5, -0.5, 0.5, 0.0]) for i in range(250)] + [(5, rows[5][1])] * 2
    rows += [(None, [1.0, 2.0, 3.0, 4.0]), (None, [1.0, 2.0, 3.0, 4.0]), (7, None), (8, []), (9, [1.0] * 3), (10, [1.0, None, 2.0, 3.0])]
    rows += [(11, [float("nan")] * 4), (12, [float("inf"), 0.0, 0.0, 0.0]), (13, [-1e-9, 0.0, -0.0, 1e-300]), (14, [-3e5, 3e5, 0.1, 0.1])]
    check(session, rows, 12, 3, 4)


@pytest.mark.parametrize("rows", [[(1, [0.0, 0.0])], [(1, [0.25, 1.0]), (2, [0.25, 1.0])], [(i, [float(i % 3), 0.0]) for i in range(9)]])
def test_few_vectors(session, rows):
    check(session, rows, 5, 2, 2)


def test_none(session):
    assert vafile.clusters(make(session, [(1, [1.0])])).collect() == []
    assert vafile.clusters(make(session, [(1, [1.0])]).limit(0)).collect() == []


def test_too_large_fails(session):
    with pytest.raises(Exception, match="a component is beyond"):
        vafile.clusters(make(session, [(1, [1e30, 0.0])]), 2, 1, 2).collect()


def test_intervals_enclose_distances():
    draw = np.random.default_rng(4)
    vectors, centroids = draw.integers(-500, 500, (400, 6)), draw.integers(-500, 500, (7, 6))
    inner = np.sort(draw.integers(-500, 500, (6, vafile.CELLS - 1)), axis=1)
    lookup = vafile.Lookup(vectors.min(0), inner, vectors.max(0), centroids)
    codes = vafile.coded(vectors, inner)
    exact = ((vectors[:, None, :] - centroids[None]) ** 2).sum(2)
    exact = exact - ((vectors - lookup.middle) ** 2).sum(1)[:, None]
    least, most = lookup.intervals(codes)
    assert (least <= exact).all() and (exact <= most).all()
    assert lookup.open(codes)[np.arange(400), exact.argmin(1)].all()


def test_full_vectors_are_not_shuffled(session, tmp_path):
    """Fetching brings numbers to the buckets."""
    session.range(1000).selectExpr("id AS number", "array(1, 2) AS vector").write.bucketBy(4, "number").sortBy("number").option("path", f"{tmp_path}/t").saveAsTable("bucketed_vectors")
    session.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        wanted = session.range(100).withColumnRenamed("id", "number").mapInArrow(lambda b: b, "number long")
        plan = wanted.join(session.table("bucketed_vectors"), "number")._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1 and "hashpartitioning(number" in plan
    finally:
        session.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        session.sql("DROP TABLE bucketed_vectors")


def test_query_against_sql(session, folder):
    database = duckdb.connect()
    database.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{folder}/embeddings.parquet'")
    df = QUERIES["op13_vafile"](session, folder)
    result = database.execute(SQL["op13_vafile"])
    columns = [c[0] for c in result.description]
    assert sorted_rows(df.columns, df.collect()) == sorted_rows(columns, result.fetchall())
