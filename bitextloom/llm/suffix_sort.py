"""Deep-shallow sorting of byte strings: multikey quicksort to a shallow depth, blind tries for what is still alike there."""

from __future__ import annotations

# Bytes that the quicksort compares at a time, and how many of them beyond the prefix common to all before a trie takes over.
WORD = 8
SHALLOW = 4 * WORD


def common_prefix(a: bytes, b: bytes) -> int:
    """Length of the longest common prefix."""
    n = min(len(a), len(b))
    differing = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (differing.bit_length() + 7) // 8


class BlindTrie:
    """Strings by the bytes at which they branch alone.

    A node is [depth, children by byte]; -1 stands for a string that ends at the depth. A leaf is the list of the
    numbers of equal strings.
    """

    def __init__(self, strings: list[bytes]) -> None:
        self.strings = strings
        self.root: list | None = None

    def insert(self, number: int) -> None:
        if self.root is None:
            self.root = [number]
            return
        string = self.strings[number]
        node = self.root
        # Down by branching bytes alone, anywhere where none fits: any leaf of the subtree tells the rest.
        while isinstance(node[-1], dict):
            depth, children = node
            byte = string[depth] if depth < len(string) else -1
            node = children.get(byte) or next(iter(children.values()))
        other = self.strings[node[0]]
        split = common_prefix(string, other)
        if split == len(string) == len(other):
            node.append(number)
            return
        # Down again to where the common prefix ends.
        above, byte, node = None, None, self.root
        while isinstance(node[-1], dict) and node[0] < split:
            above, byte = node, string[node[0]]
            node = node[1][byte]
        own = string[split] if split < len(string) else -1
        if isinstance(node[-1], dict) and node[0] == split:
            node[1][own] = [number]
            return
        branch = [split, {own: [number], other[split] if split < len(other) else -1: node}]
        if above is None:
            self.root = branch
        else:
            above[1][byte] = branch

    def ordered(self) -> list[int]:
        order, todo = [], [self.root] if self.root else []
        while todo:
            node = todo.pop()
            if isinstance(node[-1], dict):
                todo += [node[1][byte] for byte in sorted(node[1], reverse=True)]
            else:
                order += node
        return order


def deep_shallow(strings: list[bytes]) -> tuple[list[int], list[int]]:
    """Order of the strings, and the common prefix of each with the one before it in that order (0 for the first)."""
    order: list[int] = []
    if strings:
        start = common_prefix(min(strings), max(strings))
        todo = [(list(range(len(strings))), start)]
        while todo:
            group, depth = todo.pop()
            if len(group) == 1:
                order += group
            elif depth >= start + SHALLOW:
                trie = BlindTrie(strings)
                for number in group:
                    trie.insert(number)
                order += trie.ordered()
            else:
                words = [strings[i][depth : depth + WORD] for i in group]
                pivot = words[len(words) // 2]
                less = [i for i, w in zip(group, words) if w < pivot]
                same = [i for i, w in zip(group, words) if w == pivot]
                more = [i for i, w in zip(group, words) if w > pivot]
                # Equal words that are cut short are the ends of equal strings.
                deeper = (same, depth + WORD if len(pivot) == WORD else start + SHALLOW)
                todo += [part for part in ((more, depth), deeper, (less, depth)) if part[0]]
    shared = [common_prefix(strings[a], strings[b]) for a, b in zip(order, order[1:])]
    return order, [0, *shared] if order else []
