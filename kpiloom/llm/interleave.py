"""Burrows-Wheeler transforms of sets of strings, in numpy: built by shard, merged by interleave refinement.

Every string ends with a byte that no text holds. A transform lists, for the rotations of its strings in
sorted order, the byte in front of each; following it from rank to rank (``last_to_first``) spells the
strings backwards, so a transform carries its strings and their order.

``merged`` puts shards together without sorting their rotations again: shards start one after the other,
and each round deals the ranks out by the bytes in front of them. A round over ``depth`` bytes takes these
bytes as one symbol, the interval that the ranks had after the round before, so the depth doubles; a border
opens between neighbours that differ. Ranks that have no border between them after ``depth`` bytes share a
common prefix of at least that length: these are the repeated intervals.
"""

from __future__ import annotations

import numpy as np

END = 0xFF                      # not in UTF-8
WORD = 8                        # bytes compared at once


def ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The indices first..first+size-1 of all pairs, one after the other."""
    ends = np.cumsum(size)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(first - ends + size, size)


def words_of(data: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Each place's byte and those that follow by ``after``: eight as one number, the first one lowest, and ``after`` taken 1, 2 and 4 times."""
    word, jumps = data.astype(np.uint64), [after]
    for k in (8, 16, 32):
        word |= word[jumps[-1]] << np.uint64(k)
        jumps.append(jumps[-1][jumps[-1]])
    return word, jumps.pop(), jumps


def sorted_rotations(data: np.ndarray, first: np.ndarray, size: np.ndarray, part: np.ndarray) -> np.ndarray:
    """Positions of ``data`` in the order of part and rotation of its strings; ``part`` is that of each string.

    Parts ascend from 0; the strings of a part are different from each other.
    """
    n, owner = len(data), np.repeat(np.arange(len(first)), size)
    after = np.arange(1, n + 1)
    after[first + size - 1] = first
    # The part and as many bytes as there is room for, in one number.
    depth = min(WORD - 1, (64 - int(part[-1]).bit_length()) // 8)
    key = words_of(data, after)[0].byteswap() >> np.uint64(64 - 8 * depth) | (part.astype(np.uint64) << np.uint64(8 * depth))[owner]
    order = np.argsort(key)
    key = key[order]
    rank, tied = np.empty(n, np.int64), np.arange(n)
    sub = order
    while True:
        begin = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        length = np.diff(np.append(begin, len(key)))
        rank[sub] = np.repeat(tied[begin], length)
        tied = tied[np.repeat(length > 1, length)]
        if not len(tied):
            return order
        sub = order[tied]
        string = owner[sub]
        at = first[string] + (sub - first[string] + depth) % size[string]       # where the bytes compared so far end
        key = rank[sub] << 32 | rank[at]
        by = np.argsort(key)
        sub, key = sub[by], key[by]
        order[tied] = sub
        depth *= 2


def transform(data: np.ndarray, first: np.ndarray, size: np.ndarray, bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the transforms of all buckets, and the strings in the order of their own rotation in them.

    ``bucket`` is that of each string, ascending; the buckets' transforms follow each other.
    """
    order = sorted_rotations(data, first, size, np.cumsum(np.append(False, bucket[1:] != bucket[:-1])))
    before = np.arange(-1, len(data) - 1)
    before[first] = first + size - 1
    string = np.full(len(data), -1)
    string[first] = np.arange(len(first))
    string = string[order]
    return data[before[order]], string[string >= 0]


def last_to_first(last: np.ndarray, shard: np.ndarray) -> np.ndarray:
    """Rank of each rotation moved back by one byte, inside its shard. ``shard`` is ascending."""
    if len(shard) and shard[-1] < 1 << 8:
        order = np.argsort(shard.astype(np.uint16) << 8 | last, kind="stable")
    else:
        order = np.argsort(last, kind="stable")
        order = order[np.argsort(shard[order], kind="stable")]
    out = np.empty(len(last), np.int64)
    out[order] = np.arange(len(last))
    return out


def spelled(last: np.ndarray, back: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The strings (of ``size`` bytes with their end), one after the other, and where in them each rank begins."""
    by = np.argsort(-size, kind="stable")
    first = np.cumsum(size) - size
    rank = np.flatnonzero(last == END)
    rank_at = np.empty(len(last), np.int64)         # rank that begins at each place of the strings
    rank_at[first] = rank
    rank, at = back[rank[by]], (first + size - 1)[by]
    # How many strings go on after so many bytes; the longest come first.
    going = np.searchsorted(-size[by], -np.arange(1, int(size.max(initial=0))), side="left")
    for k in going.tolist():
        rank, at = rank[:k], at[:k]
        rank_at[at] = rank
        rank, at = back[rank], at - 1
    place = np.empty(len(last), np.int64)
    place[rank_at] = np.arange(len(last))
    after = np.arange(1, len(last) + 1)
    after[first + size - 1] = first
    return last[rank_at[after]], place


def merged(last: np.ndarray, back: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(ranks in the merged order, interval of each): ranks share an interval if ``depth`` bytes are equal."""
    n = len(last)

    def dealt(at, symbol, group):
        """``at`` in the order of their symbols, and intervals in which symbol and interval before are one."""
        by = np.argsort(symbol, kind="stable")
        symbol, group = symbol[by], group[by]
        border = np.zeros(n, bool)
        border[1:] = (symbol[1:] != symbol[:-1]) | (group[1:] != group[:-1])
        return at[by], np.cumsum(border)

    # The first bits of the depth in one word, then bit by bit: the depth doubles, and grows by one byte for a set bit.
    bits = max(0, depth.bit_length() - 3)
    done = depth >> bits
    word, _, jumps = words_of(last, back)
    word &= np.uint64((1 << 8 * done) - 1)
    moved = np.arange(n)
    for k, jump in enumerate(jumps):
        if done >> k & 1:
            moved = jump[moved]
    at, group = dealt(moved, word, np.zeros(n, np.int64))
    for bit in range(bits - 1, -1, -1):
        interval = np.empty(n, np.uint16 if group[-1:].max(initial=0) < 1 << 16 else np.int64)
        interval[at] = group
        at, group = dealt(moved[at], interval[moved[at]], group)
        moved = moved[moved]
        if depth >> bit & 1:
            at, group = dealt(back[at], last[at], group)
            moved = back[moved]
    return at, group
