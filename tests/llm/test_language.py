import os
from random import Random

import pytest

from viewtide.llm import language
from viewtide.llm.base import table

PIECES = [("aa", "abab abba baab bbaa abab"), ("zz", "xyzzy zyxxy yxzyx xyxyx zzyxy")]


def longest(text, sample, at):
    size = 0
    while at + size < len(text) and text[at : at + size + 1] in sample:
        size += 1
    return size


def written(symbols):
    return "".join(chr(0x100 + s) for s in symbols)


@pytest.mark.parametrize("dense", [61, 2, 0])
def test_phrases_against_search(monkeypatch, dense):
    """Phrases of the automaton and of plain substring search are as many, however many letters have columns of their own."""
    monkeypatch.setattr(language, "DENSE", dense)
    model = language.Model(tuple(PIECES))
    for text in ["abba xyz", "ab  ab!!ba", "qqq", "zzyx" * 200, "a", "Abba, XYZZY? 12 q"]:
        symbols = model.symbols(text)
        counts = model.phrases([symbols])[0]
        for k, lang in enumerate(model.langs):
            joined = " ".join(t for l, t in PIECES if l == lang)
            sample = written(model.symbols(joined))
            expected = 0
            for first in range(0, len(symbols), language.SEGMENT):
                part, at = written(symbols[first : first + language.SEGMENT]), 0
                while at < len(part):
                    at += max(1, longest(part, sample, at))
                    expected += 1
            assert counts[k] == expected, (text, lang)


def test_blocks(monkeypatch):
    model = language.Model(tuple(PIECES))
    texts = ["abba baab", None, "xyzzy", "", "123", "abab " * 500]
    whole = model.predict(texts)
    monkeypatch.setattr(language, "BLOCK", 3)
    assert model.predict(texts) == whole
    assert [w[0] for w in whole] == ["aa", "und", "zz", "und", "und", "aa"]


def test_rows(documents):
    rows = [(i, "abab abba baab bbaa", "aa", "s") for i in range(30)] + [(i, "xyzzy zyxxy yxzyx", "zz", "s") for i in range(30, 60)]
    rows += [(60, None, "aa", None), (61, "", None, None), (62, "42!", "zz", None), (None, "abba", "aa", None), (63, "שלום עולם", None, None), (63, "abba", None, None)]
    df = documents(rows)
    pieces = language.learned(df)
    found = language.identify(df, pieces).collect()
    assert len(found) == len(rows)
    expected = {0: "aa", 30: "zz", 60: "und", 61: "und", 62: "und"}
    for row in found:
        assert 0 <= row.score <= 1
        if row.doc_id in expected:
            assert row.lang_pred == expected[row.doc_id]
    kept = language.accepted(df, pieces)
    assert kept.columns == df.columns
    assert kept.count() == 62  # not the null, the empty, the numbers and the foreign text
    none = df.limit(0)
    assert language.learned(none) == [] and language.identify(none, []).collect() == []
    assert {r.lang_pred for r in language.identify(df, []).collect()} == {"und"}


def test_sample_is_bounded(documents):
    rows = [(i, f"text number {i} " * 50, f"l{i % 7}", "s") for i in range(400)] + [(i, "a copy", "l0", "s") for i in range(400, 900)]
    pieces = language.sample(documents(rows).select("lang", "text"), chars=4200, piece=200)
    assert len(pieces) == 21 and {sum(lang == f"l{k}" for lang, _ in pieces) for k in range(7)} == {3}
    assert all(len(text) <= 200 for _, text in pieces) and len(set(pieces)) == 21


def test_held_out_accuracy(session, folder):
    documents = table(session, os.path.join(os.path.dirname(folder), "sf0.01"), "documents")
    found = language.identify(documents, language.learned(documents)).join(documents.select("doc_id", "lang"), "doc_id").where("held_out")
    right = found.where("lang = lang_pred").count()
    assert right >= 0.98 * found.count()


def made_up(random, letters, words):
    """Texts of a made-up language: words of its own, drawn with unlike frequencies."""
    known = ["".join(random.choices(letters, k=random.randrange(1, 7))) for _ in range(words)]
    return lambda size: " ".join(known[min(int(random.expovariate(8 / words)), words - 1)] for _ in range(size))


def test_many_scripts(documents):
    """Languages of large and of several scripts are learned beside each other; none of their letters is left out."""
    random = Random(3)
    scripts = {
        "cyr": [chr(c) for c in range(0x430, 0x450)],
        "cyr2": [chr(c) for c in range(0x430, 0x450)],
        "ell": [chr(c) for c in range(0x3B1, 0x3CA)],
        "han": [chr(c) for c in range(0x4E00, 0x4E00 + 1500)],
        "han2": [chr(c) for c in range(0x6E00, 0x6E00 + 1500)],
        "lat": list("abcdefghijklmnopqrstuvwxyz"),
    }
    speak = {lang: made_up(random, letters, 300) for lang, letters in scripts.items()}
    df = documents([(i, speak[lang](60), lang, "s") for i, lang in enumerate(list(speak) * 100)])
    pieces = language.learned(df)
    found = language.identify(df, pieces).join(df.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(found) > 100 and sum(r.lang == r.lang_pred for r in found) >= 0.98 * len(found)
    assert language.accepted(df, pieces).count() == 600


def test_more_languages_than_pieces(documents):
    rows = [(i, f"{chr(0x4E00 + i)} {chr(0x5E00 + i)} {chr(0x4E00 + i)}", f"l{i}", "s") for i in range(30)]
    pieces = language.sample(documents(rows).select("lang", "text"), chars=2000, piece=200)
    assert {lang for lang, _ in pieces} == {f"l{i}" for i in range(30)}
    assert [p[0] for p in language.Model(tuple(pieces)).predict([t for _, t, _, _ in rows])] == [lang for _, _, lang, _ in rows]


def test_accepted_of_nothing(documents):
    none = documents([]).limit(0)
    assert language.accepted(none, []).collect() == [] and language.accepted(none, PIECES).columns == none.columns
