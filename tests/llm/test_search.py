import math
import random

import numpy as np
import pytest

from viewtide.llm import hnsw, multiindex


@pytest.fixture
def vectors(session):
    random.seed(6)
    centres = [[random.gauss(0, 1) for _ in range(16)] for _ in range(8)]
    rows = [(i, [c + random.gauss(0, 0.3) for c in random.choice(centres)]) for i in range(900)]
    rows += [(i, rows[0][1]) for i in range(900, 1300)]  # many equal ones
    odd = [(5000, None), (5100, [0.0] * 16), (5200, [math.nan] * 16), (5300, [math.inf] + [1.0] * 15), (None, [1.0] * 16), (5400, []), (5500, [None] + [1.0] * 15)]
    short = [(6000 + i, [1.0, i / 10]) for i in range(4)]
    frame = session.createDataFrame([(i, v, "x", 1) for i, v in rows + odd + short + rows[:3]], "vec_id long, embedding array<double>, key string, place int")
    return frame.repartition(3), rows, short


def brute(rows, every, k):
    ids, matrix = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    out = {}
    for i in np.flatnonzero(ids % every == 0):
        scores = np.sqrt(((matrix - matrix[i]) ** 2).sum(1))
        out[int(ids[i])] = sorted((s, int(n)) for s, n in zip(scores, ids) if n != ids[i])[:k]
    return out


def test_graph_search(vectors):
    frame, rows, short = vectors
    found = hnsw.nearest(frame, every=100, k=10, shard=300).collect()
    expected = brute(rows, 100, 10) | brute(short, 100, 10)
    lists = {}
    for row in sorted(found, key=lambda r: (r.query_id, r.rank)):
        lists.setdefault(row.query_id, []).append((row.score, row.vec_id))
    assert set(lists) == set(expected)
    right = 0
    for query, pairs in expected.items():
        assert lists[query] == sorted(lists[query]) and len(lists[query]) == len(pairs)
        right += len({p[1] for p in pairs} & {p[1] for p in lists[query]})
    assert right >= 0.95 * sum(map(len, expected.values()))
    assert [p[1] for p in lists[900]] == [0, *range(901, 910)]  # ties to the smaller id
    assert [p[1] for p in lists[6000]] == [6001, 6002, 6003]


def test_exact_search(vectors):
    frame, rows, short = vectors
    codes = {i: sum(1 << b for b, x in enumerate(v) if x > 0) for i, v in rows + short}
    expected = {}
    for query in codes:
        if query % 50 == 0:
            pairs = sorted(((codes[query] ^ c).bit_count(), i) for i, c in codes.items() if i != query)[:10]
            expected[query] = [(n + 1, i, d) for n, (d, i) in enumerate(pairs)]
    for shard in (1 << 17, 20):
        found = {}
        for r in multiindex.nearest(frame, every=50, k=10, shard=shard).collect():
            found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.distance))
        assert {q: sorted(v) for q, v in found.items()} == expected


def test_radius_covers():
    random.seed(8)
    codes = np.unique(np.array([random.getrandbits(64) for _ in range(400)] + [random.getrandbits(20) for _ in range(400)], np.uint64))
    starts = np.arange(len(codes) + 1)
    index = multiindex.Index(codes[:, None], starts, np.arange(len(codes)))
    for query in [int(codes[3]), random.getrandbits(64), random.getrandbits(20), 0, (1 << 64) - 1]:
        expected = sorted((int(d), i) for i, d in enumerate(np.bitwise_count(codes ^ np.uint64(query))))
        assert index.nearest([query], 15) == expected[:15]
        assert index.nearest([query], 5000) == expected


@pytest.mark.parametrize("size", [63, 65, 128, 200])
def test_all_components(session, size):
    """Components beyond the 64th count, also beside shorter vectors."""
    random.seed(size)
    base = [random.choice([-1.0, 1.0]) for _ in range(size)]
    rows = [(i, [x if random.random() < 0.9 else -x for x in base]) for i in range(300)]
    rows += [(300, base), (350, base[:64] + [-x for x in base[64:]]), (400, [1.0, -1.0])]
    codes = {i: sum(1 << b for b, x in enumerate(v) if x > 0) for i, v in rows}
    found = {}
    for r in multiindex.nearest(session.createDataFrame(rows, "vec_id long, embedding array<double>"), shard=90).collect():
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.distance))
    for query in range(0, 401, 50):
        pairs = sorted(((codes[query] ^ c).bit_count(), i) for i, c in codes.items() if i != query)[:10]
        assert sorted(found[query]) == [(n + 1, i, d) for n, (d, i) in enumerate(pairs)]


def test_many_lengths(session):
    """Vectors are compared with those of their own length, however many lengths there are."""
    rows = [(i, [1.0 + i // 100] * (1 + i % 100)) for i in range(300)]
    found = {}
    for r in hnsw.nearest(session.createDataFrame(rows, "vec_id long, embedding array<double>"), every=50, shard=100).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    assert found == {q: {q % 100 + 100 * n for n in range(3)} - {q} for q in range(0, 300, 50)}


def test_empty(session):
    none = session.createDataFrame([], "vec_id long, embedding array<float>")
    assert hnsw.nearest(none).collect() == [] and multiindex.nearest(none).collect() == []
