import random
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from tokenizers import Tokenizer

from viewtide.llm import bestfit, windows
from viewtide.llm.queries import TOKENIZER
from viewtide.llm.tokens import WordTokenizer
from viewtide.session import SCOPES, scratch_scope


@pytest.fixture(scope="module")
def rows():
    random.seed(2)
    words = ["Alpha", "beta's", "don't", "x1y22", "é̈", "<|endoftext|>", "naïve", "a\x1fb", "日本", "zz\xa0top", "!?", "it'SLL've", "A1.b2,,C", "~<|x", "'", "(we'd)'m", "ÅNGSTRÖM,", "İx", "5×3÷2", "ŉſĸ", "l'Été's", "ÿĀ1ß"]
    rows = [(i, " \t\n".join(random.choices(words, k=random.choice([0, 1, 5, 60, 700]))), "en", random.choice(["a", "a", "b", None])) for i in range(120)]
    return rows + [(200, None, None, "c"), (200, None, None, "c"), (None, "no id", None, "c")]


@pytest.fixture(scope="module")
def ids(rows):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    return [tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [2] for r in rows]


def test_words(rows, ids):
    tokenizer = WordTokenizer(TOKENIZER)
    texts = [None if r[1] is None else r[1].encode() for r in rows] + [b"x" * 500]
    for _ in range(2):
        found = tokenizer.batch(texts)
        assert [np.frombuffer(f, tokenizer.kind).tolist() for f in found[:-1]] == [i[:-1] for i in ids]
        assert len(found[-1]) > 2


def round_robin(queues, weights, length):
    """Plain deficit round-robin: pieces (row, start, length, sequence, offset) of queues of (row, size) by source."""
    queues = {s: [(r, a, min(length, size - a)) for r, size in q for a in range(0, size, length)] for s, q in queues.items()}
    order = sorted(queues, key=lambda s: (s is None, s))
    deficit, out, stream = dict.fromkeys(order, Fraction(0)), [], 0
    whole = sum(weights[s] for s in order)
    while any(queues.values()):
        for source in order:
            deficit[source] += Fraction(weights[source] * length, whole)
            while queues[source] and deficit[source] > 0:
                row, start, size = queues[source].pop(0)
                deficit[source] -= size
                while size:
                    part = min(size, length - stream % length)
                    last = out[-1] if out else None
                    if last and last[0] == row and last[1] + last[2] == start and stream % length:
                        out[-1] = (row, last[1], last[2] + part, *last[3:])
                    else:
                        out.append((row, start, part, stream // length, stream % length))
                    start, size, stream = start + part, size - part, stream + part
    return sorted(out)


@pytest.mark.parametrize("weights", [None, {"a": 5, "b": 1, None: 30}, {"c": 1000}])
def test_against_round_robin(documents, rows, weights):
    length = 64
    df = documents(rows)
    tokens = windows.tokenised(df, TOKENIZER, 2).collect()
    queues = defaultdict(list)
    for r in sorted(tokens, key=lambda r: (r.chunk, r.row)):
        queues[r.source].append(((r.chunk << 33) | r.row, r.size))
    weigh = {s: sum(n for _, n in q) if weights is None else weights.get(s, 1) for s, q in queues.items()}
    found = windows.pieces(df, TOKENIZER, 2, length, weights, with_ids=False).collect()
    assert sorted((r.row_id, r.start, r.length, r.sequence_id, r.offset) for r in found) == round_robin(queues, weigh, length)


def test_few_cuts(documents):
    """With 2,000 sources documents stay whole but for the borders of sequences, and shares hold."""
    random.seed(5)
    rows = [(i, "word " * random.choice([3, 30, 99]), "en", f"s{i % 2000}") for i in range(6000)]
    length = 512
    found = windows.pieces(documents(rows), TOKENIZER, 2, length, with_ids=False).collect()
    count, size, share = Counter(), {}, Counter()
    for r in found:
        count[r.row_id] += 1
        size[r.row_id] = r.doc_tokens
        share[r.sequence_id] += r.length * (r.doc_id % 2 == 0)
    assert max(count.values()) == 2 and sum(count.values()) <= len(count) + sum(size.values()) // length + 1
    even = sum(size[r.row_id] for r in found if r.start == 0 and r.doc_id % 2 == 0) / sum(size.values())
    half = len(share) // 2
    # No source is ahead or behind by more than a document; of 2,000 sources a round serves few, in order of their names.
    assert abs(sum(share[i] for i in range(half)) / (half * length) - even) < 0.15


def test_weights_refused(documents, rows):
    with pytest.raises(ValueError):
        windows.pieces(documents(rows), TOKENIZER, 2, weights={"a": 0})


def test_windows(documents, rows, ids):
    length = 64
    found = windows.pieces(documents(rows), TOKENIZER, 2, length).collect()
    texts = defaultdict(list)
    for row in found:
        texts[row.row_id].append(row)
        assert zlib.crc32(row.ids) == row.ids_crc32 and len(row.ids) == 4 * row.length
    joined = Counter()
    for pieces in texts.values():
        pieces.sort(key=lambda r: r.start)
        at = 0
        for piece in pieces:
            assert piece.start == at and piece.doc_id == pieces[0].doc_id
            at += piece.length
        assert at == pieces[0].doc_tokens
        joined[pieces[0].doc_id, tuple(np.frombuffer(b"".join(p.ids for p in pieces), "<u4"))] += 1
    assert joined == Counter((r[0], tuple(i)) for r, i in zip(rows, ids))
    sequences = defaultdict(list)
    for row in found:
        sequences[row.sequence_id].append((row.offset, row.length, row.doc_id))
    total = sum(map(len, ids))
    assert sorted(sequences) == list(range(-(-total // length)))
    for number, pieces in sequences.items():
        at = 0
        for offset, size, _ in sorted(pieces, key=lambda p: p[0]):
            assert offset == at
            at += size
        assert at == (length if number < len(sequences) - 1 else total - length * (len(sequences) - 1))


def test_ids_are_not_sorted(documents, rows):
    with scratch_scope(documents([]).sparkSession):
        plan = windows.pieces(documents(rows), TOKENIZER, 2, 64, with_ids=False)._jdf.queryExecution().executedPlan().toString()
        # Tokens, the parts of sources in order and with their sources, the rows in order.
        assert len(SCOPES[-1]) == 4
    assert "ShuffledHashJoin" in plan and "SortMergeJoin [chunk" not in plan


@pytest.mark.parametrize("weights,target", [(None, 0.25), ({"a": 1, "b": 1}, 0.5)])
def test_shares(documents, weights, target):
    """Up to every window, a source has its share but for a document, as long as it has any left."""
    rows = [(i, "word " * random.randrange(1, 90), "en", "a" if i % 4 else "b") for i in range(400)]
    found = windows.pieces(documents(rows), TOKENIZER, 2, 100, weights, with_ids=False).collect()
    share = Counter()
    for row in found:
        share[row.sequence_id] += row.length * (row.doc_id % 4 == 0)
    total = sum(share.values())
    target = total / sum(r.length for r in found) if weights is None else target
    so_far = 0
    for number in range(max(share)):
        so_far += share[number]
        if so_far > total - 200:
            break
        assert abs(so_far - target * 100 * (number + 1)) <= 200


def test_best_fit_against_scan():
    random.seed(4)
    for capacity in (1, 7, 64, 100):
        sizes = [random.randint(1, capacity) for _ in range(200)]
        free, expected = [], []
        for piece in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
            fits = [f for f in free if f >= sizes[piece]]
            if fits:
                free.remove(min(fits))
                free.append(min(fits) - sizes[piece])
            else:
                free.append(capacity - sizes[piece])
        bins = bestfit.best_fit(sizes, capacity)
        assert sorted(i for b in bins for i in b) == list(range(len(sizes)))
        assert sorted(capacity - sum(sizes[i] for i in b) for b in bins) == sorted(free)
        del expected


@pytest.mark.parametrize("buffer", [1 << 20, 500])
def test_matrices(session, documents, rows, ids, buffer, tmp_path):
    length = 128
    packed = bestfit.pack(documents(rows), TOKENIZER, 2, length, pad=7, buffer=buffer)
    found = packed.collect()
    pieces = defaultdict(list)
    for row in found:
        matrix, places = np.frombuffer(row.input_ids, "<u4"), np.frombuffer(row.position_ids, "<u4")
        assert len(matrix) == len(places) == length and row.cu_seqlens[-1] == row.tokens and (matrix[row.tokens :] == 7).all()
        for source, doc, start, a, b in zip(row.row_ids, row.doc_ids, row.starts, row.cu_seqlens, row.cu_seqlens[1:]):
            pieces[source, doc].append((start, tuple(matrix[a:b])))
            assert places[a:b].tolist() == list(range(b - a))
    joined = Counter()
    for (_, doc), parts in pieces.items():
        parts.sort()
        assert [p[0] for p in parts] == [sum(len(q[1]) for q in parts[:i]) for i in range(len(parts))]
        joined[doc, sum((p[1] for p in parts), ())] += 1
    assert joined == Counter((r[0], tuple(i)) for r, i in zip(rows, ids))
    path = str(tmp_path / "matrices")
    bestfit.write_matrices(packed, path, rows=5)
    seen = {}
    for block in bestfit.read_matrices(session, path).collect():
        matrix = np.frombuffer(block.input_ids, "<u4").reshape(block.rows, length)
        cuts, starts = np.frombuffer(block.cu_seqlens, "<u4"), np.frombuffer(block.cu_starts, "<u4")
        for i in range(block.rows):
            seen[matrix[i].tobytes()] = cuts[starts[i] : starts[i + 1]].tolist()
    assert seen == {bytes(r.input_ids): r.cu_seqlens for r in found}


def test_empty(documents):
    none = documents([]).limit(0)
    assert windows.pieces(none, TOKENIZER, 2).collect() == []
    assert bestfit.pack(none, TOKENIZER, 2).collect() == []
