"""Ratcliff-Obershelp similarity of whole texts, by windows of one text found in the other, else by names of substrings.

The longest common block of two ranges that is not short against them holds one of few windows of the shorter range, which
are searched in the other and extended; so edits of a text take a few searches. Where blocks are short, or a window stands
in too many places, both texts' substrings of length 2**j are named by the pairs of names of half the length, so any two of
one length are compared by two numbers, and the longest common block of any two ranges is found by halving its length: a
length is possible if some name pair stands in both ranges. The block first in a, then in b, is taken, and what lies left
and right of it is matched in the same way, with its length as the bound. Names are made once a pair of texts, if at all.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters of two ranges together up to which plain sets of substrings are quicker than arrays.
SMALL = 400
#: Windows of a range that are searched in the other at most, and places where they are found.
WINDOWS, PLACES = 64, 256
#: Letters, numbers and _, as functions.text has it.
WORD = re.compile(r"\w+")


def substring_names(codes: np.ndarray) -> list[np.ndarray]:
    """names[j][i] names the 2**j codes from i on; levels end where no name stands twice."""
    _, first = np.unique(codes, return_inverse=True)
    names = [first.astype(np.int64)]
    while len(names[-1]) > 1 << (len(names) - 1):
        half = 1 << (len(names) - 1)
        key = names[-1][:-half] * (len(codes) + 1) + names[-1][half:]
        different, rank = np.unique(key, return_inverse=True)
        names.append(rank.astype(np.int64))
        if len(different) == len(key):
            break
    return names


def longest(most: int, possible) -> int:
    """The greatest length of 0 to most that is possible; each shorter one is too."""
    low, high = 0, 1
    while high <= most and possible(high):
        low, high = high, 2 * high
    high = min(high, most + 1)
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if possible(middle) else (low, middle)
    return low


def windows(a: str, p: int, q: int, b: str, r: int, s: int) -> tuple[int, int, int] | None:
    """(length, place in a, place in b) of the longest common block of a[p:q] and b[r:s], the first in a, then in b; None where
    that takes too many searches. A block of 2 w - 1 characters holds a whole one of the windows of w that one range is cut
    into, so once w has given one as long, all as long are known."""
    if q - p > s - r:
        x, start, stop, y, low, high, turned = b, r, s, a, p, q, True
    else:
        x, start, stop, y, low, high, turned = a, p, q, b, r, s, False
    short, places = stop - start, 0
    w = short
    while w and short <= WINDOWS * w:
        best, ends = (0, 0, 0), {}
        for k in range(start, stop - w + 1, w):
            window = x[k : k + w]
            at = y.find(window, low, high)
            while at >= 0:
                places += 1
                if places > PLACES:
                    return None
                if ends.get(at - k, -1) < k + w:
                    left = longest(min(k - start, at - low), lambda n: x[k - n : k] == y[at - n : at])  # noqa: B023
                    right = longest(min(stop - k, high - at) - w, lambda n: x[k + w : k + w + n] == y[at + w : at + w + n])  # noqa: B023
                    ends[at - k] = k + w + right
                    i, j = (at, k) if turned else (k, at)
                    best = max(best, (left + w + right, left - i, left - j))
                at = y.find(window, at + 1, high)
        if best[0] >= min(2 * w - 1, short) or w == 1:
            return best[0], -best[1], -best[2]
        w = (best[0] + 1) // 2 or w // 2
    return None


def matching(a: str, b: str) -> int:
    """The characters of all matching blocks."""
    if a == b:
        return len(a)
    if not a or not b:
        return 0
    names, shift, width = None, len(a), len(a) + len(b) + 1

    def keys(start: int, stop: int, length: int) -> np.ndarray:
        """Numbers of the blocks of a length in a range: the names of its two ends, which overlap or meet."""
        level = min(length.bit_length(), len(names)) - 1
        step, at = 1 << level, names[level]
        return at[start : stop - length + 1] * width + at[start + length - step : stop - step + 1]

    def common(p: int, q: int, r: int, s: int, length: int):
        """The first place in a[p:q] of a block of this length that b[r:s] has too, and its first place there; or None."""
        if length > 2 << (len(names) - 1):
            return None  # nothing as long stands twice
        x, y = keys(p, q, length), keys(shift + r, shift + s, length)
        hit = np.isin(x, y)
        i = int(hit.argmax())
        return (p + i, r + int((y == x[i]).argmax())) if hit[i] else None

    def small(p: int, q: int, r: int, s: int, length: int):
        seen: dict[str, int] = {}
        for j in range(s - length, r - 1, -1):
            seen[b[j : j + length]] = j
        return next(((i, seen[a[i : i + length]]) for i in range(p, q - length + 1) if a[i : i + length] in seen), None)

    total, todo = 0, [(0, len(a), 0, len(b), min(len(a), len(b)))]
    while todo:
        p, q, r, s, most = todo.pop()
        most = min(most, q - p, s - r)
        if most <= 0:
            continue
        if (block := windows(a, p, q, b, r, s)) is not None:
            find, (length, i, j) = None, block
        elif q - p + s - r <= SMALL:
            find = small
        else:
            find = common
            if names is None:
                names = substring_names(np.frombuffer((a + b).encode("utf-32-le", "surrogatepass"), np.uint32))
        if find:
            # where blocks tie, that of the bound's length is the next one
            length = most if (at := find(p, q, r, s, most)) else longest(most - 1, lambda k: find(p, q, r, s, k) is not None)  # noqa: B023
            i, j = at or (find(p, q, r, s, length) if length else (p, r))
        if length:
            total += length
            todo += [(p, i, r, j, length), (i + length, q, j + length, s, length)]
    return total


def dice_of(a: str, b: str, stem: int = 5) -> float:
    """Dice coefficient of the multisets of word stems of two folded texts; 1 if neither has words. Words of their common
    beginning are only counted."""
    k = longest(min(len(a), len(b)), lambda n: a[:n] == b[:n])
    if k < max(len(a), len(b)):
        while k and WORD.match(a[k - 1]):
            k -= 1
    same = len(WORD.findall(a, 0, k))
    x, y = (Counter([w[:stem] for w in WORD.findall(t, k)]) for t in (a, b))
    total = 2 * same + x.total() + y.total()
    return 2 * (same + (x & y).total()) / total if total else 1.0


def closeness(text: str | None, reference: str | None, case: bool = True, whitespace: bool = True, stem: int | None = 5) -> tuple[float, float | None]:
    """(ratio, dice): 2 M / T of the normalized texts, M characters in matching blocks of T in both, and the Dice coefficient
    of their word stems (null without stem). A null is the text None in the one and no text in the other, as everywhere."""
    if text == reference:
        return 1.0, None if stem is None else 1.0
    named = ["None" if t is None else t for t in (text, reference)]
    folded = [t.casefold() for t in named]
    a, b = (" ".join(t.split()) if whitespace else t for t in (folded if case else named))
    dice = None if stem is None else dice_of(*("" if t is None else f for t, f in zip((text, reference), folded)), stem)
    return (2 * matching(a, b) / (len(a) + len(b)) if a or b else 1.0), dice


def closeness_of(text: Column, reference: Column, case: bool = True, whitespace: bool = True, stem: int | None = 5) -> Column:
    """struct<ratio,dice> of two columns of strings, as closeness has it."""

    @F.pandas_udf("ratio double, dice double")
    def measure(a: pd.Series, b: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([closeness(x, y, case, whitespace, stem) for x, y in zip(a, b)], columns=["ratio", "dice"], dtype="float64")

    return measure(text, reference)
