import random

import numpy as np
import xxhash

from viewtide.llm import simhash
from viewtide.llm.components import components


def plain(text):
    """The contract, bit by bit."""
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [words] if len(words) < 3 else [words[i : i + 3] for i in range(len(words) - 2)]
    hashes = [xxhash.xxh64_intdigest(" ".join(s).encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(ids, codes, bits):
    """Smallest id reachable over links of all pairs."""
    root = list(range(len(ids)))
    for _ in ids:
        for i, a in enumerate(codes):
            for j, b in enumerate(codes):
                if (a ^ b).bit_count() <= bits:
                    root[i] = root[j] = min(root[i], root[j])
    return [min((x for x, r in zip(ids, root) if r == root[i]), default=None) for i in range(len(ids))]


def test_fingerprint():
    texts = [None, "", " \n ", "One", "one TWO", "a b c", "É é\xa0x y z", "a b c a b c a b c", " ".join(map(str, range(500)))]
    for text in texts:
        found = simhash.fingerprint(None if text is None else text.encode())
        assert found & (1 << 64) - 1 == plain(text)


def test_slices(monkeypatch):
    text = " ".join(map(str, range(1000))).encode()
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "SLICE", 7)
    assert simhash.fingerprint(text) == whole


def test_documents(documents):
    random.seed(3)
    base = [str(random.random()) for _ in range(60)]
    rows = [(i, " ".join(base[:40] + [str(i // 3)] + base[40:]), "en", "s") for i in range(12)]
    rows += [(20, None, None, None), (21, "", "en", "s"), (22, "other words here", "en", "s"), (22, "other words here", "en", "s"), (None, "lonely text of its own", "", "")]
    found = simhash.near_duplicates(documents(rows)).collect()
    assert len(found) == len(rows)
    codes = [plain(r[1]) for r in rows]
    known = [i for i, r in enumerate(rows) if r[0] is not None]
    expected = dict(zip([rows[i][0] for i in known], groups([rows[i][0] for i in known], [codes[i] for i in known], 3)))
    for row in found:
        assert row.component_id == expected.get(row.doc_id)
        assert row.fingerprint in {format(c, "016x") for c in codes}
    kept = simhash.first_of_each(documents(rows))
    assert kept.columns == documents(rows).columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(set(expected.values())) and ids.count(None) == 1


def test_empty(documents):
    none = documents([]).limit(0)
    assert simhash.near_duplicates(none).collect() == []
    assert simhash.first_of_each(none).collect() == []


def test_crowded_buckets(session):
    """Buckets above the limit are split, down to the same groups as all pairs give."""
    random.seed(5)
    centre = random.getrandbits(64)
    codes = {centre ^ sum(1 << b for b in random.sample(range(64), random.choice([1, 2, 3, 6]))) for _ in range(150)}
    codes |= {random.getrandbits(64) for _ in range(50)}
    codes = sorted(codes)
    signed = [(i, int(np.uint64(c).astype(np.int64))) for i, c in enumerate(codes)]
    rows = session.createDataFrame(signed, "doc_id long, code long")
    edges = simhash.links(rows.select("code"), 3, bucket=32)
    roots = {r.node: r.root for r in components(edges).collect()}
    found = [roots.get(s, s) for _, s in signed]
    expected = groups(list(range(len(codes))), codes, 3)
    assert len(set(zip(found, expected))) == len(set(found)) == len(set(expected))


def test_components(session):
    chain = [(i, i + 1) for i in range(1, 40)] + [(100, 101), (101, 100), (7, 7)]
    found = components(session.createDataFrame(chain, "a long, b long")).collect()
    assert sorted(map(tuple, found)) == [(i, 1) for i in range(2, 41)] + [(101, 100)]
    assert components(session.createDataFrame([], "a long, b long")).collect() == []
