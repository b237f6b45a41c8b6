import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from viewtide.llm import collocations as c
from viewtide.llm.catalog import QUERIES, SQL
from workload.check import sorted_rows


def plain(rows, least, best, longest=4, inside=80):
    """The same by counting all phrases."""
    f, n = defaultdict(Counter), Counter()
    for _, text, lang, _ in rows:
        lang = lang or "und"
        n[lang] += 0
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lowered):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for s in range(1, longest + 1):
                f[lang].update(tuple(words[i : i + s]) for i in range(len(words) - s + 1))
    found = []
    for lang, counts in f.items():
        often = {p: a for p, a in counts.items() if a >= least}
        longer = Counter()
        for p, a in often.items():
            for s in range(2, len(p)):
                for i in range(len(p) - s + 1):
                    longer[p[i : i + s]] = max(longer[p[i : i + s]], a)
        scored = []
        for p, a in often.items():
            if len(p) > 1 and not 100 * longer[p] >= inside * a:
                score, _, l, r = min((2000000 * a // (counts[p[:k]] + counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, p, l, r) in enumerate(sorted(scored)[:best], 1):
            found.append((lang, rank, p.decode(), -a, l, r, n[lang], -score))
    return sorted(found)


def prose(seed, documents=150):
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(40)] + ["É", "Zürich", "AND", "a\x1cb", "日本", "\x00"]
    fixed = ["New York Stock Exchange", "red herring", "on the other hand", "and and and and"]
    rows = []
    for i in range(documents):
        parts = [draw.choice(fixed) if draw.random() < 0.2 else draw.choice(words) for _ in range(draw.randrange(60))]
        text = "".join(p + draw.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n", "\r\n", ";x?"]) for p in parts)
        rows.append((i, text, draw.choice(["en", "de", None, "und"]), None))
    return rows + [(900, None, "fr", None), (901, "", "fr", None), (902, " . ", None, None), (903, "long words " * 9000, "es", None), (904, "same text", "en", None), (904, "same text", "en", None)]


@pytest.mark.parametrize("least, limits", [(3, {}), (3, dict(counters=40, chunk=300, ranges=16, per_survivor=1)), (9, dict(counters=4, chunk=100, ranges=4)), (2, dict(counters=1 << 20, ranges=1))])
def test_against_all_phrases(documents, least, limits):
    rows = prose(least)
    found = sorted(map(tuple, c.collocations(documents(rows), best=200, least=least, **limits).collect()))
    assert found == plain(rows, least, 200) and len(found) > 10


def test_best_of_each_language(documents):
    rows = prose(5)
    found = sorted(map(tuple, c.collocations(documents(rows), best=3, least=3).collect()))
    assert found == plain(rows, 3, 3) and {r[1] for r in found} == {1, 2, 3}


def test_empty(documents):
    for rows in ([], [(1, None, None, None)], [(1, "one two", "en", None)]):
        assert c.collocations(documents(rows)).collect() == []


def test_summary_keeps_what_is_frequent():
    """However the mass is spread and in whatever order it comes, nothing frequent is lost and nothing is overcounted."""
    draw = np.random.default_rng(1)
    for least in (2, 5, 30):
        codes = np.concatenate([draw.integers(0, 400, 3000), draw.integers(0, 1 << 60, 20000), np.repeat(draw.integers(0, 1 << 60, 50), least)]).astype(np.uint64)
        draw.shuffle(codes)
        summary = c.Summary(len(codes) // least + 1)
        for part in np.array_split(codes, 40):
            summary.waiting.append(c.counted(part, np.ones(len(part), np.int64)))
            summary.merge()
            assert len(summary.codes) <= summary.capacity
        exact = dict(zip(*np.unique(codes, return_counts=True)))
        assert summary.taken < least
        assert {k for k, n in exact.items() if n >= least} <= set(summary.survivors(least).tolist())
        assert all(exact[k] - summary.taken <= n <= exact[k] for k, n in zip(summary.codes.tolist(), summary.counts.tolist()))


def test_hashes_of_words():
    """Words have the same hash wherever they stand, also in texts that are cut."""
    draw = random.Random(6)
    words = ["".join(draw.choice("abcé日") for _ in range(draw.randrange(1, 9))).encode() for _ in range(500)] + [b"x" * (3 << 20)]
    text, seen = c.Text(named=True), {}
    for _ in range(40):
        text.add(b" ".join(draw.choice(words[:-1]) for _ in range(9000)), "en")
    text.add(b"A " + words[-1] + b" " + b" ".join(words[:-1]), "de")
    text.close()
    assert len(text.word) == len(text.all) == 40 * 9000 + 502 and text.room.max() == 9000 and text.room[-502] == 502
    for code, number in zip(text.word.tolist(), text.all.tolist()):
        assert seen.setdefault(number, code) == code
    assert len(set(seen.values())) == len(seen)


def test_equal_hashes_are_told_apart(documents, monkeypatch):
    """Phrases are counted as text, so equal hashes only cost time."""
    rows = prose(7, 60)
    plain_hashes = c.hashed

    def poor(*args):
        starts, codes, *rest = plain_hashes(*args)
        return starts, codes & c.np.uint64(7 << 40), *rest

    monkeypatch.setattr(c, "hashed", poor)
    texts = c.Text(named=True)
    for _, text, lang, _ in rows:
        texts.add((text or "").encode(), lang or "und")
    texts.close()
    full = [np.full(1 << 13, 255, np.uint8)] * 2
    counts = Counter()
    for size, at, codes in texts.phrases(4, full):
        for a in at:
            counts[texts.language_names[texts.language[a]], texts.spelled(a, size)] += 1
    import pyarrow as pa

    batch = pa.record_batch({"text": pa.array([(r[1] or "").encode() for r in rows], pa.binary()), "lang": [r[2] or "und" for r in rows]})
    found = Counter()
    for out in c._spelled(4, full, 10**9)(iter([batch])):
        for lang, phrase, count in zip(out["lang"].to_pylist(), out["phrase"].to_pylist(), out["count"].to_pylist()):
            assert (lang, phrase) not in found
            found[lang, phrase] = count
    assert found == counts and len(found) > 1000


def test_query_against_sql(session, folder):
    database = duckdb.connect()
    database.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    df = QUERIES["op11_collocations"](session, folder)
    result = database.execute(SQL["op11_collocations"])
    columns = [x[0] for x in result.description]
    rows = df.collect()
    assert sorted_rows(df.columns, rows) == sorted_rows(columns, result.fetchall()) and len(rows) > 10
