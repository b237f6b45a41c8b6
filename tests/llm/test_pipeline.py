from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from viewtide.llm.base import table
from viewtide.llm.queries import TOKENIZER
from viewtide.session import settled


def test_registered():
    names = set(__spark_entry__.queries())
    assert "pipeline" in names
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "personal_data", "mixing", "packing"]


@pytest.fixture(scope="module")
def stages(spark, folder):
    rows = [table(spark, folder, "documents")]
    for _, stage in corpus_pipeline.STAGES:
        rows.append(settled(stage(spark, rows[-1], folder)))
    return rows


def test_stages(stages):
    documents = stages[0]
    assert all(r.columns == documents.columns for r in stages[:5])
    kept = {r.doc_id for r in stages[2].collect()}
    assert kept <= {r.doc_id for r in stages[1].collect()} <= {r.doc_id for r in documents.collect()}
    assert {r.doc_id for r in stages[3].collect()} == kept
    assert not any("@mail" in r.text for r in stages[3].collect())


def test_packed(stages):
    """The last stage against tokens worked out plainly from the rows it was given."""
    tokenizer = Tokenizer.from_file(TOKENIZER)
    expected = Counter((r.doc_id, tuple(tokenizer.encode(r.text, add_special_tokens=False).ids + [2])) for r in stages[4].collect())
    rows = defaultdict(list)
    for r in stages[5].collect():
        rows[r.row_id].append(r)
    found = Counter()
    for parts in rows.values():
        parts.sort(key=lambda r: r.start)
        found[parts[0].doc_id, tuple(np.frombuffer(b"".join(p.ids for p in parts), "<u4"))] += 1
    assert found == expected


def test_run_is_repeatable(spark, folder, stages):
    key = lambda r: tuple((v is not None, v) for v in r)
    again = corpus_pipeline.run(spark, folder)
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    assert sorted(map(tuple, again.select(columns).collect()), key=key) == sorted(map(tuple, stages[5].select(columns).collect()), key=key)


def test_stages_on_odd_rows(documents, folder):
    """Null ids, texts, languages and sources, equal rows and clashing names; and no rows at all."""
    text = "the quick brown fox jumps over the lazy dog, write to jim@x.org or anne"
    rows = [(i, f"{text} {'abcdefghij'[i % 10] * 3} number{i} of{i * 7} them{i * 11}", "en" if i % 3 else None, "s" if i % 2 else None) for i in range(40)]
    rows += [(7, None, None, None), (7, None, None, None), (None, "", "en", "s"), (None, text, None, None), (50, "42", None, "t"), (51, text, "en", "t"), (51, text, "en", "t")]
    whole = documents(rows)
    for name, stage in corpus_pipeline.STAGES:
        for df in (whole, whole.limit(0)):
            found = stage(df.sparkSession, df, folder)
            if name != "packing":
                assert found.columns == df.columns
            kept = found.collect()
            assert kept or df is not whole
            assert df is whole or not kept
            if name == "language":
                assert all(r.text and any(c.isalpha() for c in r.text) for r in kept)
            if name == "near_duplicates" and df is whole:
                assert len({r.text or "" for r in kept}) == len(kept) and sum(not r.text for r in kept) == 1
            if name == "personal_data":
                assert len(kept) == len(df.collect()) and not any("@x.org" in (r.text or "") for r in kept)
            if name == "packing" and df is whole:
                assert len({r.row_id for r in kept}) == len(rows)
