"""Deep-shallow suffix sorting of many byte strings, in one task.

Multikey quicksort orders the strings by 8-byte characters to a shallow depth.  Strings that still agree
there form a group with a long common prefix, and a blind trie orders it: the trie keeps only branching
depths and bytes, a string is walked down blindly, compared once with the leaf it meets, and put in at
the depth where the two differ.
"""

import sys

import numpy as np

SHALLOW = 24
SMALL = 6


def common_prefix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    return n - ((int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")).bit_length() + 7) // 8


def blind_trie_order(strings: list[bytes], members: list[int]) -> list[int]:
    """`members` (indices of `strings`) in order; equal strings stay together."""
    # a node is [depth, {byte or -1 for the end: child}]; a leaf is a list of equal members
    root = None
    for i in members:
        s = strings[i]
        if root is None:
            root = (None, [i])
            continue
        node = root
        while node[0] is not None:
            kids = node[1]
            node = kids.get(s[node[0]] if node[0] < len(s) else -1) or next(iter(kids.values()))
        t = strings[node[1][0]]
        depth = common_prefix(s, t)
        if depth == len(s) == len(t):
            node[1].append(i)
            continue
        parent, key, node = None, None, root
        while node[0] is not None and node[0] < depth:
            parent, key = node, s[node[0]] if node[0] < len(s) else -1
            node = node[1][key]
        own = s[depth] if depth < len(s) else -1
        if node[0] == depth:
            node[1][own] = (None, [i])
            continue
        split = (depth, {(t[depth] if depth < len(t) else -1): node, own: (None, [i])})
        if parent is None:
            root = split
        else:
            parent[1][key] = split
    out, stack = [], [root] if root else []
    while stack:
        node = stack.pop()
        if node[0] is None:
            out += node[1]
        else:
            stack += [node[1][k] for k in sorted(node[1], reverse=True)]
    return out


def sorted_order(strings: list[bytes]) -> np.ndarray:
    """Indices of `strings` in byte order, a prefix before what it begins."""
    n = len(strings)
    if not n:
        return np.zeros(0, np.int64)
    padded = np.frombuffer(b"".join(s[:SHALLOW].ljust(SHALLOW, b"\0") for s in strings), dtype=">u8")
    keys = padded.reshape(n, SHALLOW // 8).astype(np.uint64)
    out: list[int] = []
    # ranges still to be ordered, the first of them on top
    stack = [(np.arange(n), 0)]
    while stack:
        members, depth = stack.pop()
        if len(members) <= SMALL or depth == keys.shape[1]:
            out += blind_trie_order(strings, members.tolist())
            continue
        own = keys[members, depth]
        pivot = np.partition(own, len(own) // 2)[len(own) // 2]
        less, more = own < pivot, own > pivot
        for part, deeper in ((members[more], depth), (members[~(less | more)], depth + 1), (members[less], depth)):
            if len(part):
                stack.append((part, deeper))
    return np.array(out, dtype=np.int64)


def ranked(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(order, lcp): lcp[k] is the common prefix of the k-th string and the one before it, lcp[0] = -1."""
    order = sorted_order(strings)
    lcp = np.full(len(order), -1, dtype=np.int64)
    for k in range(1, len(order)):
        lcp[k] = common_prefix(strings[order[k - 1]], strings[order[k]])
    return order, lcp


assert sys.byteorder == "little"
