"""Collocations against plain counting, whatever the sample proposes."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from landledger.llm import phrase_mining as mining

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_counts(rows, longest=4):
    counts, totals = {}, Counter()
    for text, lang in rows:
        own = counts.setdefault(lang or "und" if lang is None else lang, Counter())
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            totals["und" if lang is None else lang] += len(words)
            for n in range(1, longest + 1):
                own.update(" ".join(words[i : i + n]) for i in range(len(words) - n + 1))
    return counts, totals


def brute(rows, min_count, top, cover):
    counts, totals = brute_counts(rows)
    wanted = []
    for lang, own in counts.items():
        often = {p: f for p, f in own.items() if " " in p and f >= min_count}
        found = []
        for phrase, a in often.items():
            w = phrase.split(" ")
            cuts = [
                (2_000_000 * a // (own[" ".join(w[:k])] + own[" ".join(w[k:])]), k) for k in range(1, len(w))
            ]
            score, k = min(cuts)
            if any(f" {phrase} " in f" {other} " and 100 * f >= cover * a for other, f in often.items() if other != phrase):
                continue
            found.append((-score, -a, phrase.encode(), own[" ".join(w[:k])], own[" ".join(w[k:])]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:top], 1):
            wanted.append((lang, rank, phrase.decode(), -a, l, r, totals[lang], -score))
    return sorted(wanted)


def texts(n, seed):
    random_ = random.Random(seed)
    words = ["Of", "the", "state", "art", "new", "york", "é", "a", "A", "x"]
    gaps = [" ", " ", " ", "  ", "\t", ". ", "\n", ", ", " \t "]
    for _ in range(n):
        size = random_.choice([0, 1, 2, 5, 20, 60])
        text = "".join(random_.choice(words) + random_.choice(gaps) for _ in range(size))
        yield text + random_.choice(["", "state of the art", "New York City Hall"]), random_.choice(["en", "en", "de", None, ""])


@pytest.mark.parametrize("sample", [0.0, 0.3, 1.0])
def test_against_plain_counting(spark, sample):
    rows = [*texts(300, 5), (None, "en"), ("", None), ("only one piece", "fr"), ("x y z. x y z", "a\nb")]
    docs = spark.createDataFrame([(t, l, 1, "n") for t, l in rows], "text string, lang string, rank int, phrase string")
    found = mining.mine_phrases(docs.repartition(3), min_count=7, top=25, cover=80, sample=sample).collect()
    assert sorted(map(tuple, found)) == brute(rows, 7, 25, 80)


def test_empty_and_wordless(spark):
    docs = spark.createDataFrame([(None, None), (".,;", "en")], "text string, lang string")
    assert mining.mine_phrases(docs).collect() == mining.mine_phrases(docs.filter("false")).collect() == []


def test_hot_phrase_and_overlaps(spark):
    """Occurrences that overlap all count, in one text with most of the words, too."""
    rows = [("a " * 5_000, "en")] + [("b c", "en")] * 40
    found = mining.mine_phrases(spark.createDataFrame(rows, "text string, lang string")).collect()
    assert sorted(map(tuple, found)) == brute(rows, 30, 2000, 80)


def test_scores_beyond_64_bits(spark):
    big = 9 * 10**17
    rows = [("en", None, 0, 4 * big), ("en", "x", 1, big), ("en", "y", 1, 2 * big), ("en", "x y", 2, big - 1)]
    found = spark.createDataFrame(rows, "lang string, phrase string, words int, f long")
    (row,) = mining.rank_phrases(found).collect()
    assert tuple(row) == ("en", 1, "x y", big - 1, big, 2 * big, 4 * big, 2_000_000 * (big - 1) // (3 * big))


def test_long_texts_are_counted_in_parts(monkeypatch):
    monkeypatch.setattr(mining, "SLICE_BYTES", 50)
    rows = [t for t, _ in texts(60, 9)] + ["w" * 300 + " a b c", "", "a\tb  c d, e " * 20, "ü a " * 50]
    got, total = Counter(), 0
    for data, offsets, row, context in mining._slices(pa.array(rows)):
        langs = np.array(["en"], dtype=object)
        for batch in mining._slice_counts(
            data, offsets, np.zeros(len(offsets) - 1, int), langs, [None], 4, 0, 1, context
        ):
            for r in batch.to_pylist():
                phrase, _, lang = r["gram"][2:].partition("\n")
                assert lang == "en" and r["gram"][0] == str(len(phrase.split()))
                if phrase:
                    got[phrase] += r["count"]
                else:
                    total += r["count"]
    counts, totals = brute_counts([(t, "en") for t in rows])
    assert got == counts["en"] and total == totals["en"]


def test_filter_holds_what_it_was_given(spark):
    rows = [("en", f"w{i} é{i % 7}", 2, 30) for i in range(3_000)] + [("de", "w1", 1, 30), ("und", "a b c", 3, 30)]
    bloom = mining._filter(spark.createDataFrame(rows, "lang string, phrase string, words int, f long"))
    import pandas as pd

    def hashes(lang, words):
        total = pd.util.hash_array(np.array([lang], dtype=object), categorize=False)
        for w in words:
            total = total * np.uint64(0xD1342543DE82EF95) + pd.util.hash_array(np.array([w], dtype=object), categorize=False)
        return mining.mix(total + np.uint64(len(words)))

    assert all(mining._holds(bloom, hashes(lang, p.split(" ")))[0] for lang, p, _, _ in rows)
    strange = sum(mining._holds(bloom, hashes("en", [f"v{i}"]))[0] for i in range(1_000))
    assert strange < 60
