"""Brute-force versions and small tables for the tests."""

import random
import re

DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept string, row int, component string"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingle_set(text, k):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", lower(text)) if w]
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def components(sets, percent):
    """Smallest reachable id of every id, by testing all pairs."""
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def word_grams(text, n):
    words = (text or "").split()
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}


def docs_of(spark, rows):
    """Documents with extra columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, "en", s, 0, "x", 1, "y") for i, t, s in rows], DOCS)


def prose(n, seed):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 8))) for _ in range(n))


def brute_contamination(texts, items, n):
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = {}
    for item, text in items:
        words = cut(text)
        for i in range(max(1, len(words) - n + 1)) if words else []:
            windows.setdefault(tuple(words[i : i + n]), set()).add(item)
    lengths = {len(w) for w in windows}
    for doc, text in texts:
        words, hit, found = cut(text), set(), set()
        for k in lengths:
            for i in range(len(words) - k + 1):
                if (own := windows.get(tuple(words[i : i + k]))) is not None:
                    hit |= set(range(i, i + k))
                    found |= own
        yield doc, len(words), len(hit), ",".join(sorted(str(i) for i in found if i is not None))
