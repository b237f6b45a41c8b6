import hashlib
import random
from collections import defaultdict

import duckdb
import pytest

from viewtide.llm import chat
from viewtide.llm.catalog import QUERIES, SQL
from workload.check import sorted_rows

SCHEMA = "conv_id long, turn long, role string, text string, piece string, loss int, whole string"
BITS = [*chat.MARKS, "<\\s>", "[\\/INST]", "\\", "<", "[", " ", "\n", "ok", "é😀", "[[INST]]", "<</s>>", "[ROLE] user [/ROLE]"]


def noise(random_, most=6):
    return "".join(random_.choice(BITS) for _ in range(random_.randrange(most)))


def test_guarding_is_reversible():
    draw = random.Random(1)
    for _ in range(3000):
        text = noise(draw, 9)
        assert chat.plain(chat.guarded(text)) == text
        for role in ("user", "assistant", "system", noise(draw)):
            turn, start, end = chat.fitted(role, text)
            assert list(chat.parsed(turn)) == [(role, text, start, end)]


def test_texts_without_marks_stay():
    assert chat.fitted("user", "a [b] <i>")[0] == "[INST] a [b] <i> [/INST]"
    assert chat.fitted("assistant", "")[0] == " </s>"
    assert chat.fitted("user", "</s>[INST] ok [/INST]")[0] == "[INST] <\\/s>[\\INST] ok [\\/INST] [/INST]"


@pytest.mark.parametrize("text", ["x", "[INST] a", "[INST] a</s>", "[INST]a [/INST]", "[INST] [/INST]", " a", "[ROLE] a [/ROLE]</s>", "[/INST]", "<s>", "[ROLE] [/ROLE] a</s>"])
def test_other_texts_are_refused(text):
    with pytest.raises(chat.GrammarError):
        list(chat.parsed(text))


def make(session, rows):
    return session.createDataFrame([(*r, "p", 3, "w") for r in rows], SCHEMA).repartition(4)


def expected(rows):
    groups = defaultdict(list)
    for conv, turn, role, text in rows:
        groups[conv].append((turn is not None, turn or 0, role or "", text or ""))
    found = set()
    for conv, turns in groups.items():
        turns.sort()
        said = "".join(f"{r}\n{t}\n" for _, _, r, t in turns)
        learned = "".join(t for _, _, r, t in turns if r == "assistant")
        chars = sum(len(chat.fitted(r, t)[0]) for _, _, r, t in turns)
        digest = [hashlib.sha256(s.encode()).hexdigest() for s in (said, learned)]
        found.add((conv, len(turns), digest[0], len(learned), digest[1], chars))
    return found


@pytest.mark.parametrize("part", [1, 40, chat.PART])
def test_read_back(session, part):
    """Hostile, null, empty, long and repeated turns; one conversation holds a third of all rows."""
    draw = random.Random(2)
    rows = [(c, t, draw.choice(["user", "assistant", "system", "tool </s>", None, ""]), noise(draw)) for c in range(60) for t in range(draw.randrange(1, 6))]
    rows += [(99, t, draw.choice(["user", "assistant"]), noise(draw)) for t in range(len(rows) // 2)]
    rows += [(None, 0, "user", None), (None, 1, "assistant", "x"), (70, None, "user", "first"), (70, 0, "user", "a"), (70, 0, "user", "a"), (71, 0, "assistant", "long " * 50000)]
    df = make(session, rows)
    parts = chat.formatted(df, part)
    found = [tuple(r) for r in chat.digests(parts).collect()]
    assert len(found) == len(set(found)) and set(found) == expected(rows)
    turns = defaultdict(list)
    for r in chat.recovered(parts).collect():
        turns[r.conv_id].append((r.place, r.role, r.text, r.trained))
    for conv in {r[0] for r in rows}:
        source = sorted((t is not None, t or 0, role or "", text or "") for c, t, role, text in rows if c == conv)
        assert [(r, t) for _, r, t, _ in sorted(turns[conv])] == [(r, t) for _, _, r, t in source]
        assert all(trained == (r == "assistant") for _, r, _, trained in turns[conv])


def test_empty(session):
    parts = chat.formatted(make(session, [(1, 0, "user", "x")]).limit(0))
    assert chat.digests(parts).collect() == [] and chat.recovered(parts).collect() == []


def test_query_against_sql(session, folder):
    database = duckdb.connect()
    database.execute(f"CREATE VIEW conversations AS SELECT * FROM '{folder}/conversations.parquet'")
    df = QUERIES["op12_chat"](session, folder)
    result = database.execute(SQL["op12_chat"])
    columns = [c[0] for c in result.description]
    rows = df.collect()
    assert sorted_rows(df.columns, rows) == sorted_rows(columns, result.fetchall())
    assert sum(r.conv_id == -7 for r in rows) == 1
