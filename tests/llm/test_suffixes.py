import random
from collections import defaultdict

import pyarrow as pa
import pytest

from viewtide.llm import suffixes


def brute(rows):
    """Runs of words that lie in a repeated run of MIN_WORDS words, from all runs of all texts."""
    size = suffixes.MIN_WORDS
    ids = defaultdict(list)
    for doc, text in rows:
        ids[text or ""].append(doc)
    seen = defaultdict(set)
    for text in ids:
        words = text.split()
        for i in range(len(words) - size + 1):
            seen[tuple(words[i : i + size])].add(text)
    out = []
    for text, docs in ids.items():
        words, spans = text.split(), []
        for i in range(len(words) - size + 1):
            if len(docs) > 1 or len(seen[tuple(words[i : i + size])]) > 1:
                if spans and i <= spans[-1][1]:
                    spans[-1][1] = i + size
                else:
                    spans.append([i, i + size])
        out += [(d, *s) for d in docs for s in spans]
    return sorted(out)


def words(count):
    return [f"w{random.randrange(10**9)}" for _ in range(count)]


def texts():
    random.seed(7)
    passages = [words(n) for n in (50, 51, 60, 49, 200)]
    rows = []
    for i in range(60):
        text = words(random.randrange(30, 90))
        for p in random.sample(passages, random.randrange(3)):
            text += p + words(random.randrange(5, 60))
        rows.append((i, " ".join(text)))
    rows += [(100, rows[0][1]), (101, rows[0][1]), (102, ""), (103, ""), (104, None), (105, "short text"), (106, "short text")]
    inside = " ".join(passages[0][:45])
    rows += [(107, f"{inside} {' '.join(words(20))} {inside}"), (108, " ".join(words(5000) + passages[4] + words(5000)))]
    return rows


def test_repeats(documents):
    rows = texts()
    found = suffixes.repeats(documents([(i, t, None, None) for i, t in rows])).collect()
    assert sorted((r.doc_id, r.start_word, r.end_word) for r in found) == brute(rows)
    text = dict(rows)
    for r in found:
        assert r.other_id != r.doc_id and set(text[r.doc_id].split()[r.start_word : r.end_word]) & set(text[r.other_id].split())


def test_pieces_of_a_stem(session, documents):
    """A passage that most documents share is compared over several partitions."""
    random.seed(1)
    passage = " ".join(words(70))
    rows = [(i, f"{' '.join(words(20))} {passage} {' '.join(words(20))}") for i in range(300)]
    before = session.conf.get("spark.sql.shuffle.partitions")
    session.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        found = suffixes.repeats(documents([(i, t, None, None) for i, t in rows])).collect()
    finally:
        session.conf.set("spark.sql.shuffle.partitions", before)
    assert sorted((r.doc_id, r.start_word, r.end_word) for r in found) == [(i, 20, 90) for i in range(300)]


def test_batches():
    """Neighbours in different Arrow batches are compared."""
    random.seed(2)
    shared = words(80)
    batch = pa.RecordBatch.from_pylist([{"number": i, "text": " ".join(words(10) + shared + words(10)).encode(), "places": [20]} for i in range(9)])
    rows = pa.Table.from_batches(suffixes._sides(iter([batch]))).combine_chunks().to_batches()[0]
    for order in suffixes.ORDERS:
        run = suffixes._compared(order)
        expected = list(run(iter([rows])))
        single = list(run(rows.slice(i, 1) for i in range(9)))
        flat = lambda out: sorted(str(r) for b in out for r in b.to_pylist() if r["own"] is None)
        assert flat(single) == flat(expected) and len(flat(single)) >= 16


@pytest.mark.parametrize("partitions", [3, 37])
def test_common_stems(session, documents, partitions):
    """Pairs that share just enough are found among many texts that share only one side of it."""
    random.seed(4)
    rows, stem = [], words(17)
    for _ in range(20):
        left, right = words(16), words(17)
        pair = [words(9) + left + stem + right + words(9) for _ in range(2)]
        lefts = [words(9) + left + stem + words(30) for _ in range(6)]
        rights = [words(30) + stem + right + words(9) for _ in range(6)]
        rows += [" ".join(t) for t in pair + lefts + rights]
    # Different cut points of one source, and a text that has the stem many times.
    source = words(90)
    for _ in range(60):
        cut = random.randrange(45)
        rows.append(" ".join(words(12) + source[cut : cut + random.randrange(44, 56)] + words(12)))
    rows.append(" ".join(w for _ in range(40) for w in words(20) + stem))
    rows = list(enumerate(rows))
    before = session.conf.get("spark.sql.shuffle.partitions")
    session.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        found = suffixes.repeats(documents([(i, t, None, None) for i, t in rows])).collect()
    finally:
        session.conf.set("spark.sql.shuffle.partitions", before)
    assert sorted((r.doc_id, r.start_word, r.end_word) for r in found) == brute(rows)
    assert len({r.doc_id for r in found} & {i for i in range(20 * 14) if i % 14 < 2}) == 40


def test_nothing(documents):
    none = documents([]).limit(0)
    assert suffixes.repeats(none).collect() == []
    assert suffixes.repeats(documents([(1, None, None, None), (None, "x", None, None)])).collect() == []
    same = " ".join(map(str, range(60)))
    found = suffixes.repeats(documents([(None, same, None, None), (4, same, None, None)])).collect()
    assert sorted((r.doc_id or 0, r.start_word, r.end_word) for r in found) == [(0, 0, 60), (4, 0, 60)]


def test_windows_have_one_suffix():
    """Every window of MIN_WORDS words is asked for by one suffix, the one that is selected in it."""
    random.seed(3)
    text = [w for _ in range(9) for w in words(30) + ["same"] * 40]
    places = suffixes.Grams(" ".join(text).encode()).selected()
    batch = pa.RecordBatch.from_pylist([{"number": 1, "text": " ".join(text).encode(), "places": places.tolist()}])
    rows = pa.Table.from_batches(suffixes._sides(iter([batch]))).to_pylist()
    starts = [r["pos"] - lead for r in rows for lead in range(r["least"], r["most"] + 1)]
    assert sorted(starts) == list(range(len(text) - suffixes.MIN_WORDS + 1))
    assert all(0 <= r["least"] <= r["most"] <= suffixes.SIDE for r in rows)
    # A copied window has its suffix at the same place in another text.
    grams = suffixes.Grams(" ".join(words(13) + text[25:75] + words(11)).encode())
    assert grams.minima()[13] - 13 == suffixes.Grams(" ".join(text).encode()).minima()[25] - 25
