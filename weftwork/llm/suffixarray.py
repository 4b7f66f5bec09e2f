"""Suffix arrays by induced sorting, whole buckets at a time, and permuted common prefixes.

A position is S if its suffix is smaller than the next one, else L; a leftmost S is an S behind an L (LMS). The LMS
substrings are sorted by inducing, named, and the string of their names is sorted recursively; from the order of the
LMS suffixes all others are induced. Inducing goes bucket by bucket: all entries of a bucket induce the ones before
them at once, and what falls into the same bucket is the next part of it. Names beyond a small alphabet are written as
two digits, so that the recursion too has few buckets; the order of the suffixes at every second position is then the
order wanted. Each level is at most two thirds as long as the one above on average. The recursion ends at strings of up
to ``DIRECT`` names, where buckets are few names long: they are sorted directly, by ranks of prefixes that double.
"""

import numpy as np

ALPHABET = 600  # symbols beyond which names are written as two digits
DIRECT = 120_000  # names up to which a string of names is sorted without further recursion


def _types(s: np.ndarray) -> np.ndarray:
    """True where a position is S; the empty suffix behind the end is the smallest."""
    n = len(s)
    rise = np.zeros(n, dtype=np.int8)
    rise[:-1] = np.sign(s[1:].astype(np.int64) - s[:-1].astype(np.int64))
    rise[-1] = -1
    # Equal neighbours take the type of the next position that differs.
    at = np.where(rise != 0, np.arange(n, dtype=np.int32), np.int32(n))
    following = np.minimum.accumulate(at[::-1])[::-1]
    return rise[following] > 0


def _spread(found: np.ndarray, symbols: np.ndarray, sa: np.ndarray, place: np.ndarray, step: int) -> None:
    """Puts ``found`` into the buckets of their symbols, in order, from the current places on."""
    order = np.argsort(symbols, kind="stable")
    symbols = symbols[order]
    first = np.ones(len(symbols), dtype=bool)
    first[1:] = symbols[1:] != symbols[:-1]
    starts = np.flatnonzero(first)
    counts = np.diff(np.append(starts, len(symbols)))
    within = np.arange(len(symbols)) - np.repeat(starts, counts)
    sa[place[symbols] + step * within] = found[order]
    place[symbols[starts]] += step * counts


def _induce(s: np.ndarray, is_s: np.ndarray, lms: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The suffix array that the order of ``lms`` (ascending by suffix, as far as known) induces."""
    n, k = len(s), len(sizes)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    sa = np.full(n, -1, dtype=np.int32)
    lms_symbols = s[lms]
    lms_ends = np.searchsorted(lms_symbols, np.arange(k), side="right")  # lms stand in order of their first symbol
    lms_starts = np.searchsorted(lms_symbols, np.arange(k), side="left")
    used = np.flatnonzero(sizes)
    # L from left to right. The last position is induced by the empty suffix, before all others.
    place = starts.copy()
    sa[place[s[-1]]] = n - 1
    place[s[-1]] += 1
    for c in used.tolist():
        begin = starts[c]
        while begin < place[c]:  # what a bucket induces into itself is its next part
            end = place[c]
            before = sa[begin:end] - 1
            begin = end
            before = before[before >= 0]
            before = before[~is_s[before]]
            if len(before):
                _spread(before, s[before], sa, place, 1)
        if lms_starts[c] < lms_ends[c]:
            before = lms[lms_starts[c] : lms_ends[c]] - 1
            before = before[before >= 0]
            if len(before):
                _spread(before, s[before], sa, place, 1)
    l_ends = place
    # S from right to left.
    place = ends - 1
    for c in used[::-1].tolist():
        begin = ends[c] - 1
        while begin > place[c]:
            end = place[c]
            before = sa[end + 1 : begin + 1][::-1] - 1
            begin = end
            before = before[before >= 0]
            before = before[is_s[before]]
            if len(before):
                _spread(before, s[before], sa, place, -1)
        if starts[c] < l_ends[c]:
            before = sa[starts[c] : l_ends[c]][::-1] - 1
            before = before[before >= 0]
            before = before[is_s[before]]
            if len(before):
                _spread(before, s[before], sa, place, -1)
    return sa


def _names(s: np.ndarray, lms_sorted: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """The rank of each LMS substring, in the order of ``lms_sorted``; equal substrings have the same rank."""
    n = len(s)
    end_of = np.full(n + 1, n, dtype=np.int32)
    end_of[lms[:-1]] = lms[1:] + 1  # up to and with the next leftmost S
    starts, stops = lms_sorted, end_of[lms_sorted]
    sizes = stops - starts
    new = np.ones(len(starts), dtype=bool)
    new[1:] = sizes[1:] != sizes[:-1]
    new[1:] |= stops[1:] == n
    new[1:] |= stops[:-1] == n  # the last substring ends at the end of the text and equals no other
    same = np.flatnonzero(~new)
    depth = 0
    while len(same):
        deep = same[sizes[same] > depth]
        differ = s[starts[deep] + depth] != s[starts[deep - 1] + depth]
        new[deep[differ]] = True
        same = deep[~differ]
        depth += 1
    return np.cumsum(new, dtype=np.int32) - 1


def _direct(s: np.ndarray) -> np.ndarray:
    """The suffixes of a short string in order: ranks by prefixes of 1, 2, 4, … symbols until all differ."""
    n = len(s)
    rank = np.unique(s, return_inverse=True)[1].astype(np.int64)
    width = 1
    while True:
        following = np.zeros(n, dtype=np.int64)  # a suffix that has ended comes first
        following[: max(n - width, 0)] = rank[width:] + 1
        key = rank * (n + 1) + following
        order = np.argsort(key, kind="stable")
        key = key[order]
        rank[order] = np.cumsum(np.append(0, key[1:] != key[:-1]))
        width *= 2
        if rank[order[-1]] == n - 1 or width >= n:
            return order


def suffix_array(s: np.ndarray) -> np.ndarray:
    """The positions of ``s`` (small non-negative integers) in the order of their suffixes."""
    n = len(s)
    if n == 0:
        return np.zeros(0, np.int64)
    if n == 1:
        return np.zeros(1, np.int64)
    s = np.ascontiguousarray(s, dtype=np.uint16)
    sizes = np.bincount(s)
    is_s = _types(s)
    leftmost = is_s.copy()
    leftmost[0] = False
    leftmost[1:] &= ~is_s[:-1]
    lms = np.flatnonzero(leftmost)
    if len(lms) > 1:
        first = _induce(s, is_s, lms[np.argsort(s[lms], kind="stable")], sizes)
        in_order = first[leftmost[first]]
        names = _names(s, in_order, lms)
        if names[-1] + 1 < len(lms):
            by_place = np.zeros(n, dtype=np.int32)
            by_place[in_order] = names
            reduced = by_place[lms]
            k = int(names[-1]) + 1
            if len(reduced) <= DIRECT:
                order = _direct(reduced)
            elif k <= ALPHABET:
                order = suffix_array(reduced)
            else:
                base = int(np.ceil(np.sqrt(k)))
                digits = np.empty(2 * len(reduced), dtype=np.int64)
                digits[0::2], digits[1::2] = np.divmod(reduced, base)
                order = suffix_array(digits)
                order = order[order % 2 == 0] // 2
            in_order = lms[order]
        lms = in_order
    return _induce(s, is_s, lms, sizes)


def permuted_prefixes(sa: np.ndarray, room: np.ndarray, hasher, cap: int) -> np.ndarray:
    """For each position, the longest prefix, up to ``cap``, that its suffix shares with a neighbour in ``sa``.

    ``room`` is how far a suffix may be read; pairs of which one has less than ``cap`` share less and are left at 0. The
    length is found by halving steps over range hashes, once for each pair of neighbours.
    """
    best = np.zeros(len(sa), dtype=np.int32)
    full = room[sa] >= cap
    pair = np.flatnonzero(full[:-1] & full[1:])
    one, two = sa[pair].astype(np.int64), sa[pair + 1].astype(np.int64)
    length = np.zeros(len(pair), dtype=np.int64)
    step = 1 << (cap.bit_length() - 1)
    while step:
        fits = np.flatnonzero(length + step <= cap)
        a, b = one[fits] + length[fits], two[fits] + length[fits]
        same = hasher.of(a, a + step) == hasher.of(b, b + step)
        length[fits[same]] += step
        step >>= 1
    best[one] = length
    best[two] = np.maximum(best[two], length)
    return best
