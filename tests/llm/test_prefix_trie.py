"""The prefix trie against a plain one, whatever the segments, trees and ranges; the radix tree itself."""

import hashlib
import random
import zlib

import pytest

from landledger.llm import radix_tree
from landledger.llm.prefix_trie import place_turns, prefix_trie, share_openings

SCHEMA = "conv_id long, turn long, role string, text string, depth int, n_convs string, part int"


def sequences(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            named = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()[:16]
            own.setdefault(c, []).append(((turn is not None, turn or 0), role, named, text))
    return {c: [(r, t) for _, r, _, t in sorted(turns, key=lambda x: x[:3])] for c, turns in own.items()}


def rebuilt(own):
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = own.get(c - c % 20, [])[:h] + turns[h:]
    return out


def brute(convs):
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children.get(node, [])
        leaves[node] = sum(leaves[b] for b in below) or 1
        words = len(node[-1][1].split()) if node else 0
        saved[node] = sum(saved[b] for b in below) + (len(members[node]) - 1) * words
    rows = []
    for node, own in members.items():
        ends = ",".join(str(c) for c in sorted(own) if len(convs[c]) == len(node))
        rows.append((
            min(own), len(node), min(members[node[:-1]]) if node else None, len(own), len(children.get(node, [])),
            leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(rows, key=lambda r: r[:2])


def found(frame):
    return sorted((tuple(r)[:8] for r in frame.collect()), key=lambda r: r[:2])


def conversations(n, seed, most=9, words=3):
    random_ = random.Random(seed)
    rows = []
    for c in range(n):
        size = random_.choice([1, 1, 2, 3, most])
        for turn in range(size):
            text = " ".join(random_.choice("ab") for _ in range(random_.randint(0, words)))
            rows.append((c, turn, random_.choice(["user", "user", "assistant"]), text))
    return rows


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "n", 2) for r in rows], SCHEMA)


@pytest.mark.parametrize("segment_turns, chunk_keys", [(64, 20_000), (64, 3), (2, 5), (1, 1)])
def test_against_a_plain_trie(spark, segment_turns, chunk_keys):
    rows = conversations(90, chunk_keys) + [(1_000 + i, t, "user", "a b") for i in range(30) for t in range(5)]
    rows += [(2_000 + i, t, "user", f"x{min(t, 6 + i % 3)}") for i in range(6) for t in range(9)]
    placed, convs = share_openings(place_turns(table(spark, rows).repartition(3), partitions=5))
    got = prefix_trie(placed, convs, partitions=5, segment_turns=segment_turns, chunk_keys=chunk_keys)
    assert found(got) == brute(rebuilt(sequences(rows)))


def test_odd_rows(spark):
    """Null ids, turns, roles and texts, repeated rows, equal turns, conversations that lose all turns."""
    rows = [(None, 1, "user", "x"), (0, None, None, None), (0, 0, "user", ""), (0, 0, "user", ""), (1, 5, "b", "t"), (1, 5, "a", "t")]
    rows += [(c, 0, "user", "only") for c in (23, 24, 25, 26, 47, 2**40 + 3)] + [(30, t, "u", "w " * 50_000) for t in range(3)]
    placed, convs = share_openings(place_turns(table(spark, rows)))
    got = found(prefix_trie(placed, convs))
    assert got == brute(rebuilt(sequences(rows))) and got[0][3] == 9
    empty = share_openings(place_turns(table(spark, rows).filter("false")))
    assert prefix_trie(*empty).count() == 0


def test_long_conversation(spark):
    """One conversation with most turns, and two that share a long opening with it."""
    rows = [(0, t, "user", f"w{t % 7}") for t in range(700)]
    rows += [(20, t, "user", f"w{t % 7}") for t in range(400)] + [(40, t, "user", f"w{t % 7}" if t < 301 else "z") for t in range(310)]
    placed, convs = share_openings(place_turns(table(spark, rows), partitions=6))
    assert found(prefix_trie(placed, convs, partitions=4, segment_turns=1)) == brute(rebuilt(sequences(rows)))
    assert found(prefix_trie(placed, convs)) == brute(rebuilt(sequences(rows)))


def test_layouts_and_compressed_paths():
    """Nodes grow through all four layouts and find every key; splits keep what was there."""
    random_ = random.Random(1)
    keys = [bytes([b]) + b"tail" for b in range(256)] + [b"\x05tail" + bytes([b, 7]) for b in range(40)] + [b"", b"\x05ta", b"\x05tex"]
    keys += [b"\x09tail" + bytes([b]) for b in range(9)]
    keys += [bytes(random_.choices(range(3), k=random_.randint(3, 9))) + b"\xff" for _ in range(300)]
    keys = list(dict.fromkeys(keys))
    random_.shuffle(keys)
    root = radix_tree.build(keys)
    seen, sizes, stack = {}, set(), [(root, b"")]
    while stack:
        node, path = stack.pop()
        path += node.prefix
        if node.value is not None:
            seen[path] = node.value
        assert node.count == len(node.children()) <= node.size
        sizes.add(node.size)
        for byte in range(256):
            child = node.find(byte)
            if child is not None:
                stack.append((child, path + bytes([byte])))
    assert seen == {key: i for i, key in enumerate(keys)}
    assert sizes == {4, 16, 48, 256}
