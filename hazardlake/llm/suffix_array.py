"""Suffix arrays by linear grouping, for many short strings in step.

First phase: suffixes stand in groups, at first by their first symbol, and groups are taken in descending order. When
a group is taken, each of its suffixes gets its pointer to the previous suffix of a smaller group. The suffixes pointed
to have their Lyndon prefix extended by the group's, as often as they are pointed to; they leave their groups for new
ones right above, those pointed to more often higher. In the end a group holds the suffixes of one Lyndon prefix.
Second phase: suffixes are emitted in ascending order. Each emitted suffix makes the one before it, and that one's
chain of pointers, the next of their groups. No ranks are renamed and no suffix is compared.

Strings are independent, so one step here is the same step of all strings of a batch, as numpy operations.
"""

from __future__ import annotations

import numpy as np


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ..., for every range in turn."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - (ends - size), size)


class _Groups:
    """Suffixes in slots, groups as runs of slots named by their first one."""

    def __init__(self, symbols: np.ndarray, bounds: np.ndarray) -> None:
        n = len(symbols)
        self.low = np.repeat(bounds[:-1], np.diff(bounds))
        key = self.low * (int(symbols.max()) + 1) + symbols
        self.at = np.argsort(key, kind="stable")
        self.slot = np.empty(n, np.int64)
        self.slot[self.at] = np.arange(n)
        first = np.append(True, np.diff(key[self.at]) != 0)
        starts = np.flatnonzero(first)
        self.group = np.empty(n, np.int64)
        self.group[self.at] = np.repeat(starts, np.diff(np.append(starts, n)))
        self.size = np.zeros(n, np.int64)
        self.size[starts] = np.diff(np.append(starts, n))
        self.before = self.low - 1
        self.mark = np.zeros(n, bool)

    def take(self, starts: np.ndarray) -> None:
        """Handle one group of each string: pointers of its suffixes, then the split of the groups they point to."""
        taken = self.at[_ranges(starts, self.size[starts])]
        group, low = self.group[taken], self.low[taken]
        to = taken - 1
        moving = np.flatnonzero(to >= low)
        moving = moving[self.group[to[moving]] >= group[moving]]
        while len(moving):
            here = to[moving]
            to[moving] = here = np.where(self.group[here] == group[moving], here - 1, self.before[here])
            moving = moving[here >= low[moving]]
            moving = moving[self.group[to[moving]] >= group[moving]]
        self.before[taken] = to
        to = np.sort(to[to >= low])
        first = np.flatnonzero(np.append(True, to[1:] != to[:-1])) if len(to) else to
        self.split(to[first], np.diff(np.append(first, len(to))))

    def split(self, moved: np.ndarray, times: np.ndarray) -> None:
        """Move suffixes to the top of their groups, in new groups by ``times``."""
        if len(moved) == 0:
            return
        old = self.group[moved]
        order = np.argsort(old * (int(times.max()) + 1) + times, kind="stable")
        moved, times, old = moved[order], times[order], old[order]
        first = np.flatnonzero(np.append(True, old[1:] != old[:-1]))
        count = np.diff(np.append(first, len(moved)))
        top = _ranges(old[first] + self.size[old[first]] - count, count)
        leaving = self.slot[moved]
        self.mark[moved] = True
        displaced = self.at[top]
        displaced = displaced[~self.mark[displaced]]
        self.mark[moved] = False
        if len(displaced):
            self.mark[top] = True
            free = np.sort(leaving[~self.mark[leaving]])
            self.mark[top] = False
        else:
            free = displaced
        self.at[free], self.slot[displaced] = displaced, free
        self.at[top], self.slot[moved] = moved, top
        self.size[old[first]] -= count
        new = np.flatnonzero(np.append(True, (old[1:] != old[:-1]) | (times[1:] != times[:-1])))
        sizes = np.diff(np.append(new, len(moved)))
        self.size[top[new]] = sizes
        self.group[moved] = np.repeat(top[new], sizes)


def suffix_arrays(symbols: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sorted suffix starts of every string ``symbols[bounds[j]:bounds[j + 1]]``, in the strings' own places.

    Each string must be non-empty and end in a symbol smaller than all its others.
    """
    groups = _Groups(symbols, bounds)
    ends = bounds[1:]
    lows = bounds[:-1]
    starts = groups.group[groups.at[ends - 1]]
    while len(starts):
        groups.take(starts)
        left = starts > lows
        starts, lows = starts[left], lows[left]
        starts = groups.group[groups.at[starts - 1]]
    out = np.full(len(symbols), -1, np.int64)
    placed = np.zeros(len(symbols) + 1, bool)
    front = np.arange(len(symbols))
    lows = bounds[:-1]
    place, out[lows] = lows.copy(), ends - 1
    placed[ends - 1] = True
    suffix = ends - 2
    while len(place):
        go = (suffix >= lows) & ~placed[suffix]
        chosen = suffix[go]
        group = groups.group[chosen]
        out[front[group]] = chosen
        front[group] += 1
        placed[chosen] = True
        suffix[go] = groups.before[chosen]
        rest = ~go
        place[rest] += 1
        over = place >= ends
        if over.any():
            place, suffix, lows, ends, rest = (x[~over] for x in (place, suffix, lows, ends, rest))
        suffix[rest] = out[place[rest]] - 1
    return out
