"""Suffix arrays of one block by two-stage sorting, and runs of equal prefixes in them."""

from __future__ import annotations

import numpy as np

WORD = 8  # bytes compared at once


def words_at(text: np.ndarray, depth: int) -> np.ndarray:
    """The eight bytes from each position on, as numbers in the order of the bytes; beyond the end are zeros."""
    padded = np.concatenate([text, np.zeros(depth + 2 * WORD, np.uint8)])
    rows = np.lib.stride_tricks.as_strided(padded, (len(text) + depth + WORD, WORD), (1, 1))
    return np.ascontiguousarray(rows).view(">u8").ravel().astype(np.uint64)


def _smaller_than_next(text: np.ndarray) -> np.ndarray:
    """Is a suffix smaller than its successor?  Equal bytes decide like the next different pair; the last suffix is larger than the empty one."""
    step = np.sign(np.diff(text.astype(np.int16)))
    step = np.append(step, -1)
    places = np.where(step != 0, np.arange(len(step)), len(step))
    following = np.minimum.accumulate(places[::-1])[::-1]
    return step[following] > 0


def _sort(at: np.ndarray, words: np.ndarray, depth: int) -> np.ndarray:
    """The positions in the order of their first ``depth`` bytes; only what ties so far is sorted again."""
    at = at[np.argsort(words[at], kind="stable")]
    group = np.zeros(len(at), np.int64)
    if len(at):
        group[1:] = np.cumsum(words[at][1:] != words[at][:-1])
    for skip in range(WORD, depth, WORD):
        size = np.bincount(group, minlength=1)
        tied = np.flatnonzero(size[group] > 1)
        if not len(tied):
            break
        own = words[at[tied] + skip]
        order = np.lexsort((own, group[tied]))
        at[tied] = at[tied][order]
        own, old = own[order], group[tied]
        new = np.zeros(len(group), bool)
        new[1:] = group[1:] != group[:-1]
        split = np.zeros(len(tied), bool)
        split[1:] = (own[1:] != own[:-1]) & (old[1:] == old[:-1])
        new[tied] |= split
        group = np.cumsum(new)
    return at


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """All suffixes of ``text``, in order as far as their first ``depth`` bytes decide.

    Stage one sorts the suffixes that are smaller than their successors.  Stage two scans the buckets of first bytes from the
    smallest on: whatever stands there tells the place of the suffix one byte longer, if that one is larger than its successor.
    """
    n = len(text)
    out = np.empty(n, np.int64)
    if not n:
        return out
    rising = _smaller_than_next(text)
    sizes = np.bincount(text, minlength=256)
    begin = np.concatenate([[0], np.cumsum(sizes)])
    fill = begin[:-1].copy()  # next free place for induced suffixes, at the front of each bucket
    direct = _sort(np.flatnonzero(rising), words_at(text, depth), depth)
    counts = np.bincount(text[direct], minlength=256)
    for c, part in enumerate(np.split(direct, np.cumsum(counts)[:-1])):
        out[begin[c + 1] - len(part) : begin[c + 1]] = part

    def induce(scanned: np.ndarray) -> None:
        longer = scanned[scanned > 0] - 1
        longer = longer[~rising[longer]]
        first = text[longer]
        order = np.argsort(first, kind="stable")
        longer, first = longer[order], first[order]
        cuts = np.flatnonzero(np.diff(first)) + 1
        for part in np.split(longer, cuts) if len(longer) else ():
            c = text[part[0]]
            out[fill[c] : fill[c] + len(part)] = part
            fill[c] += len(part)

    induce(np.array([n]))  # the empty suffix
    for c in range(256):
        done, last = begin[c], begin[c + 1] - counts[c]
        while done < last:  # runs of one byte induce within their own bucket
            upto = fill[c]
            induce(out[done:upto])
            done = upto
        induce(out[last : begin[c + 1]])
    return out


def equal_runs(order: np.ndarray, text: np.ndarray, length: int) -> np.ndarray:
    """Number the runs of neighbours in ``order`` whose common prefixes are at least ``length`` long."""
    words = words_at(text, length)
    new = np.ones(len(order), bool)
    if len(order) > 1:
        a, b = order[:-1], order[1:]
        same = np.ones(len(a), bool)
        for skip in [*range(0, length - WORD, WORD), length - WORD]:
            left = np.flatnonzero(same)
            same[left] = words[a[left] + skip] == words[b[left] + skip]
        new[1:] = ~same
    return np.cumsum(new) - 1
