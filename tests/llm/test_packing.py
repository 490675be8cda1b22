"""Sequence packing: exact round trips, the sum-of-squares rule against a plain version, odd rows."""

import random

import numpy as np
import pyarrow as pa
import pytest
from brute_force import prose

from landledger.llm import packing

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def whole(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


def check(pieces, wanted, capacity):
    """Every id in exactly one piece, gapless sequences, no padding but at powers of two."""
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
        by_sequence.setdefault(p.sequence_id, []).append(p)
    found = {}
    for doc_id, own in by_doc.items():
        assert all(p.length == len(p.ids) // 4 > 0 for p in own)
        ids = [(p.start, np.frombuffer(p.ids, "<u4").tolist()) for p in own]
        found[doc_id] = sorted(i for start, own_ids in ids for i in enumerate(own_ids, start))
    assert found == {d: [i for text in texts for i in enumerate(text)] if len(texts) == 1 else sorted(
        i for text in texts for i in enumerate(text)) for d, texts in wanted.items()}
    for own in by_sequence.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at == capacity or (at < capacity and at & (at - 1) == 0)


def test_round_trip_and_odd_rows(spark, tokenizer):
    texts = [(i, prose(random.Random(i).randint(1, 400), i)) for i in range(120)]
    texts += [(200, None), (201, ""), (202, "  \n\t "), (None, "no id"), (7, "the same id again"), (7, "the same id again")]
    texts += [(203, "word " * 9_000), (204, "x" * 30_000), (205, "a<|endoftext|>b É \x85 <|im_end|>")]
    rows = [(i, t, "clash", "clash", b"clash") for i, t in texts]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, length string, offset binary")
    pieces = packing.pack(docs.repartition(3), PATH, capacity=256).collect()
    wanted = {}
    for i, t in texts:
        wanted.setdefault(i, []).append(whole(tokenizer, t))
    check(pieces, wanted, 256)
    empty = docs.filter("false")
    assert packing.pack(empty, PATH).count() == 0


def test_sequences(spark, tokenizer):
    docs = spark.createDataFrame([(i, prose(40, i)) for i in range(30)], "doc_id long, text string").coalesce(1)
    rows = packing.sequences(packing.pack(docs, PATH, capacity=128)).collect()
    assert all(r.tokens * 4 == len(r.ids) for r in rows)
    assert sum(r.tokens for r in rows) == sum(len(whole(tokenizer, prose(40, i))) for i in range(30))
    assert {d for r in rows for d in r.doc_ids} == set(range(30))


@pytest.mark.parametrize("capacity", [8, 61, 256])
def test_rule(capacity):
    """Each piece goes where the sum of squared level counts becomes least."""
    random_ = random.Random(capacity)
    packer = packing._Packer(capacity, 0)
    for i in range(3_000):
        size = random_.randint(1, capacity - 1)
        counts = packer.counts.copy()
        packer.add(i, np.zeros(size, np.uint32))

        def after(level):
            new = counts.copy()
            new[level] -= level > 0
            new[level + size] += level + size < capacity
            return int((new * new).sum())

        choices = [after(h) for h in range(capacity - size + 1) if h == 0 or counts[h]]
        assert int((packer.counts * packer.counts).sum()) == min(choices)
        assert packer.counts.sum() == packer.open == sum(len(w) for w in packer.windows.values())
    packer.close()
    lengths = {}
    for _, _, length, _, sequence, _, _ in packer.done:
        lengths[sequence] = lengths.get(sequence, 0) + length
    assert sum(n < capacity for n in lengths.values()) <= capacity.bit_length()
    assert all(n == capacity or n & (n - 1) == 0 for n in lengths.values())


def test_open_windows_are_bounded(monkeypatch):
    monkeypatch.setattr(packing, "OPEN_WINDOWS", 16)
    packer = packing._Packer(100, 0)
    for i in range(500):
        packer.add(i, np.full(60, i, np.uint32))  # no two fit together
        assert packer.open <= 16
    packer.close()
    assert sum(row[2] for row in packer.done) == 30_000


def test_long_texts_are_tokenised_in_parts(monkeypatch, tokenizer):
    monkeypatch.setattr(packing, "SLICE_BYTES", 1_000)
    monkeypatch.setattr(packing, "MOST_KNOWN", 20)
    with open(PATH, encoding="utf-8") as file:
        known = packing._words(file.read())
    texts = [prose(300, 1), "", "y" * 5_000 + " " + prose(50, 2), "é " * 2_000, "z" * 3_000]
    found = {}
    for row, ids, offsets in packing._token_slices(pa.array(texts), known):
        for i in range(len(offsets) - 1):
            found[row + i] = [*ids[offsets[i] : offsets[i + 1]].tolist(), 2]
    assert found == {i: whole(tokenizer, t) for i, t in enumerate(texts)}


def test_joining_tokenizer_is_refused():
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        joining = packing._Words(file.read())  # a blank is part of its words
    with pytest.raises(ValueError, match="white space"):
        packing._test_words(joining, "two words")
