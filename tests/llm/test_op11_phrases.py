"""Occurrences by hand, and phrases against plain counting."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tickloom.llm import op11_phrases as m

LOWER = {i: i + 32 for i in range(65, 91)}


def pieces(text):
    for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
        yield re.findall(r"[^\x20\x09]+", piece)


def plain(rows, least=30, longest=4, first=2000):
    """The result for rows of (text, lang)."""
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for words in pieces(text):
            n[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i : i + k])] += 1
    found = {key: a for key, a in f.items() if a >= least and len(key[1]) > 1}
    most = Counter()
    for (lang, words), a in found.items():
        for k in range(2, len(words)):
            for i in range(len(words) - k + 1):
                key = (lang, words[i : i + k])
                most[key] = max(most[key], a)
    out = defaultdict(list)
    for (lang, words), a in found.items():
        if 100 * most[lang, words] < 80 * a:
            cuts = [(f[lang, words[:k]], f[lang, words[k:]]) for k in range(1, len(words))]
            score, _, (left, right) = min((2_000_000 * a // (x + y), k, (x, y)) for k, (x, y) in enumerate(cuts))
            out[lang].append((-score, -a, " ".join(words).encode(), left, right))
    return sorted(
        (lang, i + 1, p.decode(), -a, left, right, n[lang], -score)
        for lang, rows in out.items()
        for i, (score, a, p, left, right) in enumerate(sorted(rows)[:first])
    )


def of_frame(spark, rows, **options):
    frame = spark.createDataFrame(rows, "text string, lang string")
    return sorted(tuple(r) for r in m.collocations(frame, "text", "lang", **options).collect())


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="aB \t.,\n\r\x0bé\x1f", max_size=40))
def test_words_and_places(text):
    data, begin, end, at = m.occurrences(text.encode())
    want, place = [], 0
    for piece in pieces(text):
        for i, word in enumerate(piece):
            want.append((word, place + i))
        place += len(piece) + 1 if piece else 0
    assert [(data[a:b].tobytes().decode(), p) for a, b, p in zip(begin, end, at.tolist())] == want


def test_long_texts_are_cut_between_pieces(monkeypatch):
    monkeypatch.setattr(m, "CHUNK_BYTES", 10)
    text = b"one two three four five. six, seven eight nine ten\neleven"
    assert list(m.parts(text)) == [b"one two three four five.", b" six, seven eight nine ten\n", b"eleven"]


def test_phrases_by_counting(spark):
    words = ["new", "york", "city", "of", "the", "a"]
    rows = [(" ".join(words[(i * j + j // 3) % 6] for j in range(1, 30)) + ". New York city", ["en", None, "fr", "und"][i % 4]) for i in range(60)]
    rows += [("the the the the the the", "en")] * 12 + [(None, "en"), ("", None), ("é É ñ.! ", "fr")]
    for least in (3, 30):
        got = of_frame(spark, rows, least=least)
        assert got == plain(rows, least) and got


def test_first_rows_and_ties(spark):
    rows = [("a b. c d. e f. b a", "en"), ("a b, c d\te f? b a", "en")] * 20
    assert of_frame(spark, rows, first=3) == plain(rows, first=3)
    assert [r[2] for r in plain(rows, first=3)] == ["c d", "e f", "a b"]


def test_many_chunks_and_a_very_long_text(spark):
    long = "so it goes, on and on and on; " * 300_000  # more than one chunk
    rows = [(long, "en")] + [(f"on and on it goes {i % 7} and so it goes", lang) for i in range(400) for lang in ("en", "de")]
    frame = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    extra = {c: frame["text"] for c in ("chunk", "word", "count", "grp", "n", "first")}
    got = sorted(tuple(r) for r in m.collocations(frame.withColumns(extra), "text", "lang").collect())
    assert got == plain(rows)


def test_nothing(spark):
    assert of_frame(spark, []) == []
    assert of_frame(spark, [(None, None), ("one two", "en")]) == []
