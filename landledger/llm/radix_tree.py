"""An adaptive radix tree: nodes of four sizes, compressed paths."""

from __future__ import annotations

from bisect import bisect_left


class Node:
    """A byte path (``prefix``), the row that ends behind it (``value``) and children by their next byte.

    Up to 4, then 16 children lie in sorted lists; up to 48 in slots behind an index of 256
    bytes; up to 256 in an array by byte. A node grows when its layout is full.
    """

    __slots__ = ("prefix", "value", "size", "count", "keys", "slots")

    def __init__(self, prefix: bytes, value: int | None = None):
        self.prefix, self.value = prefix, value
        self.size, self.count = 4, 0
        self.keys: bytearray | None = bytearray()
        self.slots: list[Node | None] = []

    def find(self, byte: int) -> Node | None:
        if self.size <= 16:
            at = self.keys.find(byte)
            return self.slots[at] if at >= 0 else None
        if self.size == 48:
            at = self.keys[byte]
            return self.slots[at - 1] if at else None
        return self.slots[byte]

    def put(self, byte: int, child: Node) -> None:
        """Add a child, or put another one in its place."""
        if self.find(byte) is None:
            if self.count == self.size:
                self._grow()
            self.count += 1
            if self.size <= 16:
                at = bisect_left(self.keys, byte)
                self.keys.insert(at, byte)
                self.slots.insert(at, child)
                return
            if self.size == 48:
                self.slots.append(child)
                self.keys[byte] = len(self.slots)
                return
        if self.size <= 16:
            self.slots[self.keys.find(byte)] = child
        elif self.size == 48:
            self.slots[self.keys[byte] - 1] = child
        else:
            self.slots[byte] = child

    def children(self) -> list[Node]:
        """Children in the order of their bytes."""
        if self.size <= 16:
            return self.slots
        if self.size == 48:
            return [self.slots[at - 1] for at in self.keys if at]
        return [child for child in self.slots if child is not None]

    def _grow(self) -> None:
        if self.size == 4:
            self.size = 16
        elif self.size == 16:
            index = bytearray(256)
            for at, byte in enumerate(self.keys):
                index[byte] = at + 1
            self.size, self.keys = 48, index
        else:
            self.slots = [self.slots[at - 1] if at else None for at in self.keys]
            self.size, self.keys = 256, None


def build(keys: list[bytes]) -> Node:
    """The tree of distinct keys; a key's value is its number in the list."""
    root = Node(b"")
    for value, key in enumerate(keys):
        node, above, at = root, None, 0
        while True:
            prefix = node.prefix
            if not key.startswith(prefix, at):
                same = 0
                while at + same < len(key) and prefix[same] == key[at + same]:
                    same += 1
                split = Node(prefix[:same])
                node.prefix = prefix[same + 1 :]
                split.put(prefix[same], node)
                if above is None:
                    root = split
                else:
                    above.put(key[at - 1], split)
                node = split
            at += len(node.prefix)
            if at == len(key):
                node.value = value
                break
            child = node.find(key[at])
            if child is None:
                node.put(key[at], Node(key[at + 1 :], value))
                break
            node, above, at = child, node, at + 1
    return root
