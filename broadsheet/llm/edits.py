"""Edit distances of lines: of one pair, of many at once, and bounds of them."""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from itertools import accumulate

import numpy as np

# Words of 64 table cells that are worked on at once, over all pairs of a group.
GROUP_WORDS = 1 << 13
# Fewer pairs are measured one by one.
GROUP_PAIRS = 12
# Columns between two looks for pairs that are settled.
LOOK = 32
# Characters of a pair from which on words are tried first: they take their number, the table its square.
LONG = 1_000
# Characters of a pair from which on the table's middle is tried before the whole.
VERY_LONG = 6_000


def edit_distance(a: str, b: str, most: int | None = None) -> int:
    """Levenshtein distance, without what both begin and end with, a column of the table
    in two integers. Where it is more than `most`, some number above that: along the last
    cell's diagonal the table never falls, so the first value above it settles that."""
    a, b = _trimmed(a, b)
    if not a or not b:
        return len(a) + len(b)
    places = _places(a)
    size = min(len(a), len(b))
    if max(len(a), len(b)) > VERY_LONG:
        for part in (64, 16, 6):
            band = size // part
            if abs(len(a) - len(b)) <= band and (d := _in_band(a, b, band, places)) <= band:
                return d
    full, top, score = (1 << len(a)) - 1, 1 << (len(a) - 1), len(a)
    up, down = full, 0
    row, diagonal = len(a) - len(b), abs(len(a) - len(b))
    for c in b:
        equal = places.get(c, 0)
        level = (((equal & up) + up) ^ up) | equal | down
        if most is not None and row >= 0:
            diagonal += not level >> row & 1
            if diagonal > most:
                return diagonal
        row += 1
        more, less = down | ((level | up) & full ^ full), up & level
        score += bool(more & top) - bool(less & top)
        more = more << 1 | 1
        up, down = ((less << 1) | ((level | more) & full ^ full)) & full, more & level & full
    return score


def _places(a: str) -> dict[str, int]:
    """Where each character stands, as the bits of an integer."""
    places: dict[str, int] = {}
    if len(a) < LONG:
        for i, c in enumerate(a):
            places[c] = places.get(c, 0) | 1 << i
        return places
    found: dict[str, list[int]] = {}
    for i, c in enumerate(a):
        found.setdefault(c, []).append(i)
    for c, at in found.items():
        bits = np.zeros(len(a), np.uint8)
        bits[at] = 1
        places[c] = int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")
    return places


def _in_band(a: str, b: str, band: int, places: dict[str, int]) -> int:
    """The distance, if it is no more than `band`, else some number above that: only the
    cells up to so far from the main diagonal are looked at. A column's lowest cell is
    followed down to the last row, and along it then."""
    width, score = 2 * band + 1, band
    full, top = (1 << width) - 1, width - 1
    up, down = full ^ ((1 << band) - 1), 0
    for i, c in enumerate(b):
        equal = places.get(c, 0)
        equal = (equal >> (i - band) if i >= band else equal << (band - i)) & full
        level = ((((equal & up) + up) ^ up) | equal | down) & full
        more, less = down | ((level | up) ^ full), level & up
        if i < len(a) - band:
            score += not level >> top & 1
        else:
            top -= 1
            score += (more >> top & 1) - (less >> top & 1)
        if score > band + len(b) - len(a) + band:
            return score
        level >>= 1
        up, down = less | ((level | more) ^ full), level & more
    return score


def _trimmed(a: str, b: str) -> tuple[str, str]:
    """Two strings without what both begin and end with."""
    for end in (False, True):
        low, high = 0, min(len(a), len(b))
        while low < high:
            mid = (low + high + 1) // 2
            same = a[len(a) - mid :] == b[len(b) - mid :] if end else a[:mid] == b[:mid]
            low, high = (mid, high) if same else (low, mid - 1)
        a, b = (a[: len(a) - low], b[: len(b) - low]) if end else (a[low:], b[low:])
    return a, b


def edits_at_most(a: str, b: str) -> int:
    """As many edits as turn one string into the other for certain: words that each has once
    stay where they stand in the same order, and between them all is replaced that differs."""
    words_a, words_b = a.split(" "), b.split(" ")
    once = {w: i for i, w in enumerate(words_b)}
    for w, n in Counter(words_b).items():
        if n > 1:
            del once[w]
    for w, n in Counter(words_a).items():
        if n > 1:
            once.pop(w, None)
    both = [(i, once[w]) for i, w in enumerate(words_a) if w in once]
    # The longest run of them that rises on both sides.
    tops: list[int] = []
    tails: list[int] = []
    before = [-1] * len(both)
    for k, (_, j) in enumerate(both):
        at = bisect_left(tops, j)
        if at:
            before[k] = tails[at - 1]
        tops[at : at + 1], tails[at : at + 1] = [j], [k]
    kept, k = [], tails[-1] if tails else -1
    while k >= 0:
        kept.append(both[k])
        k = before[k]
    starts_a, starts_b = (list(accumulate((len(w) + 1 for w in x), initial=0)) for x in (words_a, words_b))
    a, b, total = a + " ", b + " ", 0
    end_a, end_b = len(a), len(b)
    for i, j in [*kept, (-1, -1)]:
        from_a, from_b = (starts_a[i + 1], starts_b[j + 1]) if i >= 0 else (0, 0)
        if a[from_a:end_a] != b[from_b:end_b]:
            total += max(end_a - from_a, end_b - from_b)
        if i >= 0:
            end_a, end_b = starts_a[i], starts_b[j]
    return total


def edit_distances(pairs: list[tuple[str, str]], most: np.ndarray) -> np.ndarray:
    """edit_distance of many pairs, each with its own bound: pairs of about the same length go
    through the table together, as the same steps on arrays."""
    out = np.zeros(len(pairs), np.int64)
    n = np.fromiter((max(len(a), len(b)) for a, b in pairs), np.int64, len(pairs))
    order, end = np.argsort(n, kind="stable"), len(pairs)
    while end:
        longest = int(n[order[end - 1]])
        words = -(-longest // 64)
        start = max(int(np.searchsorted(n[order[:end]], longest - max(longest // 8, 16))), end - max(GROUP_WORDS // max(words, 1), 1))
        some = order[start:end]
        if len(some) < GROUP_PAIRS:
            out[some] = [edit_distance(*pairs[i], int(most[i])) for i in some]
        else:
            out[some] = _group_distances([pairs[i] for i in some], longest, most[some])
        end = start
    return out


def _group_distances(pairs: list[tuple[str, str]], n: int, most: np.ndarray) -> np.ndarray:
    """Distances of pairs of which the longer ones have up to `n` characters. All are made as
    long as that by the same character put before both. The rows of the table are cut into words of
    64; in a step each word takes the column after the one that the word below it takes, so
    all words of all pairs are worked on at once."""
    number, words = len(pairs), -(-n // 64)
    short, long = ([sorted(p, key=len)[k] for p in pairs] for k in (0, 1))
    sizes, points = [], []
    for side in (short, long):
        sizes.append(np.fromiter(map(len, side), np.int64, number))
        points.append(np.frombuffer("".join(side).encode("utf-32-le", "surrogatepass"), np.uint32))
    pad = n - sizes[1]
    own, at = [], []
    for size in sizes:
        own.append(np.repeat(np.arange(number), size))
        at.append(np.arange(size.sum()) - np.repeat(np.cumsum(size) - size - pad, size))
    # The characters of each pair's shorter one by number, 0 for others, 1 for that put before.
    letters = np.zeros(1 + max(int(x.max(initial=0)) for x in points), np.int64)
    letters[points[0]] = 1
    used = np.flatnonzero(letters)
    letters[used] = np.arange(1, len(used) + 1)
    has = np.zeros((number, len(used) + 1), np.int64)
    has[own[0], letters[points[0]]] = 1
    has[:, 0] = 1
    codes = np.cumsum(has, 1) * has
    codes[:, 0] = 0
    kinds = int(codes.max(initial=1)) + 1
    equal = np.zeros((words, number, kinds), np.uint64)
    np.add.at(equal.reshape(-1), ((at[0] >> 6) * number + own[0]) * kinds + codes[own[0], letters[points[0]]], np.uint64(1) << (at[0] & 63).astype(np.uint64))
    equal[:, :, 1] = _low_bits(pad - 64 * np.arange(words)[:, None])
    equal = equal.reshape(-1)
    # Columns come last first, so that the words of a step find theirs in a row.
    text = np.ones((n, number), np.int64)
    text[n - 1 - at[1], own[1]] = codes[own[1], letters[points[1]]]
    place = (np.arange(words)[:, None] * number + np.arange(number)) * kinds
    rows, last = sizes[0] + pad, sizes[0] - sizes[1]
    up, down = np.full((words, number), ~np.uint64(0)), np.zeros((words, number), np.uint64)
    # What goes from a word to that below it, and the values in the last rows of the words.
    more, less, more_next, less_next = np.zeros((4, words + 1, number), np.uint64)
    more[0] = more_next[0] = 1
    value = np.repeat(64 * np.arange(1, words + 1)[:, None], number, 1).astype(np.uint64)
    out, live = np.zeros(number, np.int64), np.arange(number)

    def cell(row: np.ndarray) -> np.ndarray:
        """The table's values in these rows, counted from 1, in the columns their words have had."""
        w, p = (row - 1) >> 6, np.arange(len(row))
        rest = ~_low_bits(row - 64 * w)
        return value[w, p].astype(np.int64) - np.bitwise_count(up[w, p] & rest) + np.bitwise_count(down[w, p] & rest)

    one, top = np.uint64(1), np.uint64(63)
    for step in range(n + words - 1):
        low, high = max(0, step - n + 1), min(words, step + 1)
        # The word `low` takes the column step - low.
        first = n - 1 - (step - low)
        eq = equal.take(place[low:high] + text[first : first + high - low])
        pv, mv = up[low:high], down[low:high]
        xv = eq | mv
        eq |= less[low:high]
        xh = eq & pv
        xh += pv
        xh ^= pv
        xh |= eq
        ph = np.bitwise_or(xh, pv, out=eq)
        np.invert(ph, out=ph)
        ph |= mv
        xh &= pv
        ph_out = np.right_shift(ph, top, out=more_next[low + 1 : high + 1])
        mh_out = np.right_shift(xh, top, out=less_next[low + 1 : high + 1])
        value[low:high] += ph_out
        value[low:high] -= mh_out
        ph <<= one
        ph |= more[low:high]
        xh <<= one
        xh |= less[low:high]
        np.bitwise_and(ph, xv, out=mv)
        ph |= xv
        np.invert(ph, out=ph)
        np.bitwise_or(ph, xh, out=pv)
        more, less, more_next, less_next = more_next, less_next, more, less
        if step % LOOK == LOOK - 1 and step < n - 1:
            # Along the last cell's diagonal the table never falls. A row on it whose word has
            # had the row's column: the column of word w is step + 1 - w.
            w = np.maximum(step + 1 + last, 0) // 65
            row = step + 1 - w + last
            diagonal = np.where((row > 64 * w) & (row <= 64 * w + 64), cell(np.clip(row, 64 * w + 1, 64 * w + 64)), 0)
            gone = diagonal > most
            if 4 * gone.sum() >= len(live):
                out[live[gone]] = diagonal[gone]
                stay = ~gone
                if not stay.any():
                    return out
                live, most, rows, last = live[stay], most[stay], rows[stay], last[stay]
                text, place, up, down, value = (np.compress(stay, x, 1) for x in (text, place, up, down, value))
                more, less, more_next, less_next = (np.compress(stay, x, 1) for x in (more, less, more_next, less_next))
    out[live] = cell(np.maximum(rows, 1))
    out[live[rows == 0]] = n
    return out


def _low_bits(count: np.ndarray) -> np.ndarray:
    """Words with so many of their lowest bits set: none below 1, all from 64 on."""
    shift = np.clip(64 - count, 1, 63).astype(np.uint64)
    return np.where(count >= 64, ~np.uint64(0), np.where(count > 0, ~np.uint64(0) >> shift, np.uint64(0)))


def edit_bounds(a: list[str], b: list[str], percent: int, beyond: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of pairs of strings: bounds of their edits, and whether they are close, that is at least
    `percent` of the longer one unedited. Where edits are more than `beyond` times as many as
    close ones may have, the lower bound is about that."""
    low, high, most = (np.zeros(len(a), np.int64) for _ in range(3))
    left: list[int] = []
    pairs: list[tuple[str, str]] = []
    for i, (x, y) in enumerate(zip(a, b)):
        most[i] = max(len(x), len(y)) * (100 - percent) // 100
        low[i], high[i] = abs(len(x) - len(y)), max(len(x), len(y))
        if low[i] <= most[i]:
            pair = _trimmed(x, y)
            high[i] = max(map(len, pair))
            # Those that may be far apart are not worth the words' bound.
            if most[i] < high[i] and LONG < high[i] and beyond > 1:
                high[i] = min(high[i], edits_at_most(*pair))
            if high[i] > most[i]:
                left.append(i)
                pairs.append(pair)
    bound = beyond * most[left]
    low[left] = found = edit_distances(pairs, bound)
    high[left] = np.where(found <= bound, found, high[left])
    return low, high, high <= most
