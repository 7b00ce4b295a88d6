"""Deep-shallow sorting of the suffixes of a set of strings, as far as `width` bytes.

Suffixes are sorted by multikey quicksort to a shallow depth, eight bytes at a time: one word orders a
class, and only ties go on to the next. What is still tied there has a long common prefix and is
ordered by a blind trie, which compares each suffix with one other in full. Suffixes that agree in all of
`width` bytes are what the caller looks for.
"""

from __future__ import annotations

import numpy as np

SHALLOW = 24


class BlindTrie:
    """Suffixes of one text by their first `width` bytes. Inner nodes hold a depth and children by the byte
    there; leaves are lists of the starts of equal suffixes."""

    def __init__(self, text: bytes, width: int):
        self.text, self.width, self.root = text, width, None

    def insert(self, start: int) -> list[int]:
        """The leaf that `start` ends up in: all starts so far with the same `width` bytes."""
        if self.root is None:
            self.root = [start]
            return self.root
        text, width, end = self.text, self.width, start + self.width
        node = self.root
        while isinstance(node, tuple):  # blind: only the bytes at the branches are looked at
            depth, children = node
            node = children.get(text[start + depth]) or next(iter(children.values()))
        other = node[0]
        unlike = int.from_bytes(text[start:end], "big") ^ int.from_bytes(text[other : other + width], "big")
        common = width - (unlike.bit_length() + 7) // 8
        if common == width:
            node.append(start)
            return node
        leaf, byte = [start], text[start + common]
        above, node = None, self.root
        while isinstance(node, tuple) and node[0] < common:
            above = node
            node = node[1][text[start + node[0]]]
        if isinstance(node, tuple) and node[0] == common:
            node[1][byte] = leaf
            return leaf
        inner = (common, {byte: leaf, text[other + common]: node})
        if above is None:
            self.root = inner
        else:
            above[1][text[start + above[0]]] = inner
        return leaf

    def leaves(self) -> list[list[int]]:
        """In the order of the suffixes."""
        out, stack = [], [self.root] if self.root is not None else []
        while stack:
            node = stack.pop()
            if isinstance(node, list):
                out.append(node)
            else:
                stack.extend(child for _, child in sorted(node[1].items(), reverse=True))
        return out


def _words(raw: np.ndarray, starts: np.ndarray, depth: int) -> np.ndarray:
    """The eight bytes at `depth` of each suffix, as a number that sorts like them."""
    out = np.zeros(len(starts), np.uint64)
    for i in range(8):
        out = (out << np.uint64(8)) | raw[starts + (depth + i)]
    return out


def tied(text: bytes, starts: np.ndarray, classes: np.ndarray, depth: int) -> list[np.ndarray]:
    """Multikey quicksort of the suffixes of `text` at `starts` to `depth` bytes, the class of each
    being its first key: the groups that are still equal, in order, without single ones."""
    raw = np.frombuffer(text, np.uint8)
    order = np.argsort(classes, kind="stable")
    starts, group = starts[order], _ranks(classes[order])
    for at in range(0, depth, 8):
        sizes = np.bincount(group) if len(group) else np.zeros(0, int)
        several = sizes[group] > 1 if len(group) else np.zeros(0, bool)
        starts, group = starts[several], group[several]
        if not len(starts):
            return []
        word = _words(raw, starts, at)
        order = np.lexsort((word, group))
        starts, word, group = starts[order], word[order], group[order]
        fresh = np.concatenate(([False], (group[1:] != group[:-1]) | (word[1:] != word[:-1])))
        group = np.cumsum(fresh)
    parts = np.split(starts, np.flatnonzero(np.diff(group)) + 1)
    return [p for p in parts if len(p) > 1]


def _ranks(ordered: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(ordered[1:] != ordered[:-1]))) if len(ordered) else ordered


def repeated(text: bytes, starts: np.ndarray, classes: np.ndarray, width: int, shallow: int = SHALLOW) -> np.ndarray:
    """Which of `starts` (each at least `width` bytes before the end) share all `width` bytes with
    another one of the same class. Starts come sorted."""
    found = np.zeros(len(starts), bool)
    where = {}
    for part in tied(text, starts, classes, min(shallow, width // 8 * 8)):
        if len(part) == 2:
            a, b = int(part[0]), int(part[1])
            if text[a : a + width] == text[b : b + width]:
                where[a] = where[b] = True
            continue
        trie = BlindTrie(text, width)
        for start in part.tolist():
            trie.insert(start)
        for leaf in trie.leaves():
            if len(leaf) > 1:
                where.update(dict.fromkeys(leaf, True))
    if where:
        found[np.searchsorted(starts, np.fromiter(where, np.int64, len(where)))] = True
    return found
