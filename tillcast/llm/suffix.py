"""Suffix arrays by two-stage sorting, on numpy arrays.

Stage one sorts directly only the suffixes that are smaller than their
successor; stage two induces the order of all others by scanning the buckets
(first bytes) from the smallest on: the predecessor of each suffix, if it is
larger than that suffix, is the next one of its own bucket.  Every bucket is
handled with whole-array steps.

Order is by the first ``depth`` bytes (at least); suffixes that agree on them
are in no defined order.  The text must end where a comparison may run past
it: the buffer is padded with zeros.
"""

from __future__ import annotations

import numpy as np


def words8(buf: np.ndarray, n: int) -> np.ndarray:
    """Big-endian value of the 8 bytes at each of the first n places (buf is padded by 8 or more)."""
    view = np.ndarray(shape=(n,), dtype="<u8", buffer=buf.data, strides=(1,))
    return view.byteswap()


def _direct(words: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """``at`` sorted by the first ``depth`` bytes of their suffixes: 8 bytes a round, ties only."""
    n = len(words)
    if not len(at):
        return at
    key = words[at]
    order = np.argsort(key, kind="stable")
    at, key = at[order], key[order]
    # a group is named by the place of its first member
    new = np.concatenate(([True], key[1:] != key[:-1]))
    group = np.flatnonzero(new)[np.cumsum(new) - 1]
    done = 8
    live = np.arange(len(at))
    while done < depth:
        size = np.bincount(group[live])
        live = live[size[group[live]] > 1]
        if not len(live):
            break
        pos = at[live] + done
        key = np.where(pos < n, words[np.minimum(pos, n - 1)], 0)
        order = np.lexsort((key, group[live]))
        at[live] = at[live][order]
        key = key[order]
        g = group[live]
        new = np.concatenate(([True], (key[1:] != key[:-1]) | (g[1:] != g[:-1])))
        group[live] = live[np.flatnonzero(new)][np.cumsum(new) - 1]
        done += 8
    return at


def suffix_array(text: np.ndarray, depth: int = 1 << 30) -> np.ndarray:
    """Places of all suffixes of ``text`` (uint8) in order of their first ``depth`` bytes."""
    n = len(text)
    if n == 0:
        return np.zeros(0, np.int64)
    depth = min(depth, n)
    buf = np.concatenate((text, np.zeros(16, np.uint8)))
    words = words8(buf, n)
    # smaller than the successor: the next different byte is larger (the end counts as smallest)
    t = text.astype(np.int16)
    nxt = np.concatenate((t[1:], [-1]))
    change = t != nxt
    idx = np.where(change, np.arange(n), n)
    idx = np.minimum.accumulate(idx[::-1])[::-1]        # the next change at or after each place
    small = t[idx] < nxt[idx]
    direct = _direct(words, np.flatnonzero(small), depth)

    first = np.searchsorted(text[direct], np.arange(257), side="left")
    # buckets to come: pieces of induced suffixes, in the order they are found
    found: list[list[np.ndarray]] = [[] for _ in range(256)]
    last = n - 1
    if not small[last]:
        found[text[last]].append(np.array([last], dtype=np.int64))
    out = []
    for c in range(256):
        own = direct[first[c]:first[c + 1]]
        if not found[c] and not len(own):
            continue
        fresh = np.concatenate(found[c]) if found[c] else np.zeros(0, np.int64)
        large = [fresh]
        while len(fresh):                               # runs of the same byte stay in this bucket
            p = fresh[fresh > 0] - 1
            fresh = p[(text[p] == c) & ~small[p]]
            large.append(fresh)
        bucket = np.concatenate([*large, own])
        out.append(bucket)
        p = bucket[bucket > 0] - 1
        p = p[(text[p] > c) & ~small[p]]
        if len(p):
            order = np.argsort(text[p], kind="stable")
            p = p[order]
            heads = np.flatnonzero(np.concatenate(([True], text[p][1:] != text[p][:-1])))
            for a, b in zip(heads, [*heads[1:], len(p)]):
                found[text[p[a]]].append(p[a:b])
        found[c] = []
    return np.concatenate(out)


def adjacent_equal(text: np.ndarray, sa: np.ndarray, length: int) -> np.ndarray:
    """Whether each suffix shares at least ``length`` bytes with the one before it (first: False)."""
    n = len(text)
    out = np.zeros(len(sa), dtype=bool)
    if len(sa) < 2:
        return out
    words = words8(np.concatenate((text, np.zeros(16, np.uint8))), n)
    a, b = sa[:-1], sa[1:]
    live = np.flatnonzero((a + length <= n) & (b + length <= n))
    step = [*range(0, length - 7, 8)]
    if length >= 8 and step[-1] != length - 8:
        step.append(length - 8)
    if length < 8:
        keep = words >> np.uint64(8 * (8 - length))
        live = live[keep[a[live]] == keep[b[live]]]
    for s in step if length >= 8 else []:
        live = live[words[a[live] + s] == words[b[live] + s]]
    out[live + 1] = True
    return out
