"""A compressed radix (Patricia) trie over byte strings with owners at its terminal nodes."""

from __future__ import annotations

from collections.abc import Iterator

#: Rough bytes of a node besides its label.
NODE_BYTES = 400


class _Node:
    __slots__ = ("label", "children", "owner", "evicted")

    def __init__(self, label: bytes):
        self.label, self.children, self.owner, self.evicted = label, {}, None, False


def better(a: tuple, b: tuple) -> tuple:
    """Of two owners (code points, id, rows): most code points, then smallest id; rows add up."""
    keep = a if (-a[0], a[1]) <= (-b[0], b[1]) else b
    return keep[0], keep[1], a[2] + b[2]


def _shared(label: bytes, key: bytes, at: int) -> int:
    """Length of the common prefix of ``label`` and ``key[at:]`` by bisection."""
    low, high = 0, min(len(label), len(key) - at)
    while low < high:
        mid = (low + high + 1) // 2
        if label[low:mid] == key[at + low:at + mid]:
            low = mid
        else:
            high = mid - 1
    return low


class RadixTrie:
    """Maps byte strings to owners; ``held`` estimates its memory.

    A subtree that ``evict`` took out stays marked: ``insert`` answers False for the
    strings below it, which the caller passes on instead.
    """

    def __init__(self):
        self.root, self.held, self.strings = _Node(b""), 0, 0

    def insert(self, key: bytes, owner: tuple) -> bool:
        node, at = self.root, 0
        while at < len(key):
            child = node.children.get(key[at])
            if child is None:
                child = _Node(key[at:])
                node.children[key[at]] = child
                self.held += len(child.label) + NODE_BYTES
                node, at = child, len(key)
                break
            n = len(child.label) if key.startswith(child.label, at) else _shared(child.label, key, at)
            if n < len(child.label):
                upper = _Node(child.label[:n])
                child.label = child.label[n:]
                upper.children[child.label[0]] = child
                node.children[key[at]] = upper
                self.held += NODE_BYTES
                child = upper
            elif child.evicted:
                return False
            node, at = child, at + n
        if node.owner is None:
            node.owner = owner
            self.strings += 1
        else:
            node.owner = better(node.owner, owner)
        return True

    def items(self, node: _Node | None = None, prefix: bytes = b"") -> Iterator[tuple[bytes, tuple]]:
        """All (string, owner) below ``node``, whose own label ends ``prefix``; one string at a time is whole."""
        node = node or self.root
        if node.owner is not None:
            yield prefix, node.owner
        labels, below = [prefix], [iter(node.children.values())]
        while below:
            child = next(below[-1], None)
            if child is None:
                below.pop()
                labels.pop()
                continue
            labels.append(child.label)
            below.append(iter(child.children.values()))
            if child.owner is not None:
                yield b"".join(labels), child.owner

    @staticmethod
    def _weight(node: _Node) -> tuple[int, int]:
        """Bytes and strings of a subtree."""
        total, strings, stack = 0, 0, [node]
        while stack:
            at = stack.pop()
            total += len(at.label) + NODE_BYTES
            strings += at.owner is not None
            stack.extend(at.children.values())
        return total, strings

    def evict(self) -> Iterator[tuple[bytes, tuple]]:
        """Take out the heaviest subtree that leaves something behind, and yield its strings.

        Below the first node that branches (or owns a string itself), so at least one
        string stays and every round gets on.
        """
        node, path = self.root, b""
        while node.owner is None and len(node.children) == 1:
            node = next(iter(node.children.values()))
            path += node.label
        branches = [c for c in node.children.values() if not c.evicted]
        if len(branches) + (node.owner is not None) < 2:
            return
        (weight, strings), heaviest = max(((self._weight(c), c) for c in branches), key=lambda x: x[0][0])
        taken = _Node(heaviest.label)
        taken.children, taken.owner = heaviest.children, heaviest.owner
        self.held -= weight - NODE_BYTES - len(heaviest.label)
        self.strings -= strings
        heaviest.children, heaviest.owner, heaviest.evicted = {}, None, True
        yield from self.items(taken, path + heaviest.label)
