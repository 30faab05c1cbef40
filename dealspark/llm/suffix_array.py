"""Suffix arrays by induced sorting, and permuted common prefixes, in numpy.

Induced sorting classifies suffixes as smaller (S) or larger (L) than the next
one, sorts the leftmost smaller ones (LMS), and induces the order of all others
in two linear scans. LMS substrings get names by their rank; names that repeat
are a smaller string whose suffixes are sorted in turn by the same induction, at
every level and for alphabets of any size. LMS substrings are short, so they are
ranked by their letters, as many at a time as a machine word holds.

The scans go by batches of neighbouring buckets, none of which induces a suffix
in another of its batch. All suffixes that a batch induces are placed by one
stable distribution, and those that a bucket induces in itself (runs of one
letter) step by step of all runs at once, so the work per suffix is vectorised.
Where names are many, letters that follow each other are far apart, and a batch
takes many buckets. Where names ascend one by one (sorted lists) a batch is one
bucket; batches of a few suffixes are scanned one suffix at a time instead.
"""

from __future__ import annotations

import numpy as np

#: A batch of buckets with no more suffixes than this is scanned suffix by suffix, in the same order.
FEW = 32

#: So few LMS substrings that still tie are ranked by their remaining bytes, and more by a word of letters at a time.
TIES = 64


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Start positions of all suffixes of ``text`` (uint8) in lexicographic order; a prefix sorts first."""
    if not len(text):
        return np.zeros(0, np.int64)
    values = np.append(text.astype(np.int32) + 1, 0)
    return _sort(values)[1:].astype(np.int64)


def _sort(s: np.ndarray) -> np.ndarray:
    """Suffix array of ``s``, whose last value is its unique smallest, 0."""
    n = len(s)
    s = s.astype(np.min_scalar_type(int(s.max())))  # narrow letters sort and load faster
    smaller = _classify(s)
    lms = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    if n == 1 or not len(lms):
        return np.argsort(s, kind="stable")
    counts = np.bincount(s)
    ends = np.cumsum(counts)
    starts = ends - counts
    letters = np.flatnonzero(counts)
    batches = _batches(s, smaller, letters)
    names, kinds = _name(s, smaller, lms)
    ranked = lms[np.argsort(names) if kinds == len(lms) else _sort(names)]
    return _induce(s, smaller, ranked, starts, ends, batches)


def _classify(s: np.ndarray) -> np.ndarray:
    """True where the suffix is smaller than the next one; the last one (the sentinel) is."""
    n = len(s)
    step = (s[1:] > s[:-1]).astype(np.int8) - (s[1:] < s[:-1])  # > 0: smaller
    at = np.where(step != 0, np.arange(n - 1), n)
    following = np.minimum.accumulate(at[::-1])[::-1]  # next place where neighbours differ
    out = np.ones(n, bool)
    out[:-1] = step[np.minimum(following, n - 2)] > 0
    return out


def _name(s: np.ndarray, smaller: np.ndarray, lms: np.ndarray) -> tuple[np.ndarray, int]:
    """The name of each LMS substring, in text order: its rank among the distinct ones.

    A substring goes on to the next LMS position. Letters count with their type,
    L before S, so none is a proper prefix of another: the end of the one would be
    an S after an L inside the other, which ends there as well.
    """
    typed = (s.astype(np.uint32) << np.uint32(1)) | smaller
    size = np.append(np.diff(lms) + 1, 1)
    bits = int(typed.max()).bit_length()
    letters = 64 // bits

    def word(which: np.ndarray, done: int) -> np.ndarray:
        """The letters after the first ``done`` ones of some substrings, as a number."""
        out, at, left = np.zeros(len(which), np.uint64), lms[which] + done, size[which] - done
        for k in range(letters):
            if k < 2 or not len(which):  # nearly all go on
                more = np.flatnonzero(left > k)
            else:
                more = more[left[more] > k]
            out[more] |= typed[at[more] + k].astype(np.uint64) << np.uint64(bits * (letters - 1 - k))
        return out

    first = word(np.arange(len(lms)), 0)
    order = np.argsort(first)
    rank, tied = np.empty(len(lms), np.int32), np.zeros(len(lms), bool)
    rank[order], tied[order] = _ranks(first[order])
    done, active = letters, np.flatnonzero(tied & (size > letters))
    while len(active) > TIES:
        # all that tie go on alike, so ties are complete groups of one rank
        words, base = word(active, done), rank[active]
        order = np.lexsort((words, base))
        active, words, base = active[order], words[order], base[order]
        new, old = np.ones((2, len(active)), bool)
        old[1:] = base[1:] != base[:-1]
        new[1:] = old[1:] | (words[1:] != words[:-1])
        at = np.arange(len(active), dtype=np.int32)
        rank[active] = base + np.maximum.accumulate(np.where(new, at, 0)) - np.maximum.accumulate(np.where(old, at, 0))
        done += letters
        active = active[~(new & np.append(new[1:], True)) & (size[active] > done)]
    groups: dict[int, list[tuple[bytes, int]]] = {}
    for k in active.tolist():
        rest = typed[lms[k] + done:lms[k] + size[k]].astype(">u4").tobytes()
        groups.setdefault(int(rank[k]), []).append((rest, k))
    for base, group in groups.items():
        group.sort()
        for j, (rest, k) in enumerate(group):
            rank[k] = rank[group[j - 1][1]] if j and rest == group[j - 1][0] else base + j
    used = np.zeros(len(lms), bool)
    used[rank] = True
    return (np.cumsum(used, dtype=np.int32) - 1)[rank].astype(np.int32), int(used.sum())


def _ranks(ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of sorted values: how many are smaller than each, and whether another one equals it."""
    new = np.ones(len(ordered), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    rank = np.maximum.accumulate(np.where(new, np.arange(len(ordered), dtype=np.int32), 0))
    return rank, ~(new & np.append(new[1:], True))


def _batches(s: np.ndarray, smaller: np.ndarray, letters: np.ndarray) -> tuple[list, list]:
    """The batches of buckets, as pairs of (first, last) letter, of the scan for
    L suffixes from the left and of that for S suffixes from the right."""
    to, by = s[:-1], s[1:]  # the letter of a suffix, and of the one that induces it
    above = np.full(len(letters) and int(letters[-1]) + 1, np.iinfo(np.int32).max, np.int64)
    larger = ~smaller[:-1] & (to != by)
    np.minimum.at(above, by[larger].astype(np.intp), to[larger].astype(np.int64))
    below = np.full(len(above), -1, np.int64)
    less = smaller[:-1] & (to != by)
    np.maximum.at(below, by[less].astype(np.intp), to[less].astype(np.int64))
    left = _until(letters, above[letters])
    right = _until(-letters[::-1], -below[letters[::-1]])
    return left, [(-last, -first) for first, last in right]


def _until(letters: np.ndarray, limits: np.ndarray) -> list[tuple[int, int]]:
    """Cut ascending ``letters`` into batches whose letters lie before the limits of all of the batch."""
    out, first, last, limit = [], None, None, -np.inf
    for letter, own in zip(letters.tolist(), limits.tolist()):
        if letter >= limit:
            out.append((first, last))
            first, limit = letter, own
        elif own < limit:
            limit = own
        last = letter
    return [*out[1:], (first, last)]


def _induce(s: np.ndarray, smaller: np.ndarray, lms: np.ndarray, starts: np.ndarray, ends: np.ndarray,
            batches: tuple[list, list]) -> np.ndarray:
    """All suffixes in the order that the order of the LMS suffixes implies."""
    n = len(s)
    out = np.full(n, -1, np.int32)
    _place(out, lms, s[lms], ends - np.bincount(s[lms], minlength=len(starts)))
    larger = ~smaller
    here = np.arange(n, dtype=np.int32)
    turn = np.concatenate([[True], s[1:] != s[:-1]])
    run = np.zeros(n + 1, np.int32)  # equal letters right before each position; the last entry is for empty places, -1
    run[:n] = here - np.maximum.accumulate(np.where(turn, here, 0))
    gives_larger, gives_smaller = np.zeros((2, n + 1), bool)  # the suffix before, of another letter, is L; is S
    gives_larger[1:n] = larger[:-1] & turn[1:]
    gives_smaller[1:n] = smaller[:-1] & turn[1:]

    head = starts.copy()
    for first, last in batches[0]:
        batch = out[starts[first]:ends[last]]
        if len(batch) <= FEW:
            for k in range(len(batch)):
                p = batch[k] - 1
                if p >= 0 and larger[p]:
                    out[head[s[p]]] = p
                    head[s[p]] += 1
            continue
        back = _run_back(batch, run)  # an LMS suffix has no equal letter before it
        _place(out, back, s[back], head)
        p = batch[gives_larger[batch]] - 1
        _place(out, p, s[p], head)

    out[(out >= 0) & smaller[out]] = -1  # the LMS suffixes come back among all S ones
    run[:n][larger] = 0
    tail = ends.copy()
    for first, last in batches[1]:
        batch = out[starts[first]:ends[last]][::-1]
        if len(batch) <= FEW:
            for k in range(len(batch)):
                p = batch[k] - 1
                if p >= 0 and smaller[p]:
                    tail[s[p]] -= 1
                    out[tail[s[p]]] = p
            continue
        back = _run_back(batch, run)
        _place(out, back, s[back], tail, down=True)
        p = batch[gives_smaller[batch]] - 1
        _place(out, p, s[p], tail, down=True)
    out[0] = n - 1
    return out


def _run_back(found: np.ndarray, run: np.ndarray) -> np.ndarray:
    """The suffixes that a bucket induces in itself: from each of ``found`` back
    to the start of its run of equal letters, one step of all of them at a time."""
    steps = run[found]
    found, steps = found[steps > 0], steps[steps > 0]
    if not len(found):
        return found
    total = int(steps.sum())
    which = np.repeat(np.arange(len(found)), steps)
    step = np.arange(1, total + 1) - np.repeat(np.cumsum(steps) - steps, steps)
    order = np.argsort(step, kind="stable")
    return found[which[order]] - step[order]


def _place(out: np.ndarray, positions: np.ndarray, letter: np.ndarray, at: np.ndarray, down: bool = False) -> None:
    """Distribute ``positions`` stably over their letters' buckets, upwards from
    ``at`` or downwards before it; ``at`` moves on."""
    if not len(positions):
        return
    order = np.argsort(letter, kind="stable")
    letter = letter[order]
    first = np.flatnonzero(np.concatenate([[True], letter[1:] != letter[:-1]]))
    size = np.diff(np.append(first, len(letter)))
    which = letter[first]
    step = np.arange(len(letter)) - np.repeat(first, size)
    base = np.repeat(at[which], size)
    out[base - 1 - step if down else base + step] = positions[order]
    at[which] += -size if down else size


def common_prefixes(text: np.ndarray, order: np.ndarray) -> np.ndarray:
    """For each position, the length that its suffix shares with the one before
    it in ``order`` (permuted longest common prefixes).

    Where the letters before both positions are equal, the value is the previous
    position's less one; only the others are compared, eight letters at a time,
    and those lengths add up to O(n log n).
    """
    n = len(text)
    before = np.empty(n, np.int64)
    before[order[1:]] = order[:-1]
    if n:
        before[order[0]] = -1
    here = np.arange(n)
    follows = (before > 0) & (here > 0)
    follows[follows] = text[here[follows] - 1] == text[before[follows] - 1]
    follows &= np.concatenate([[False], before[:-1] >= 0]) if n else follows
    roots = np.flatnonzero(~follows)
    length = _compare(text, roots, before[roots])
    which = np.cumsum(~follows) - 1
    return np.maximum(length[which] - (here - roots[which]), 0) if n else before


def _compare(text: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many letters the suffixes at ``a`` and ``b`` (-1: none) share."""
    n = len(text)
    padded = np.concatenate([text, np.zeros(16, np.uint8)])
    words = np.lib.stride_tricks.sliding_window_view(padded, 8)
    room = np.where(b >= 0, n - np.maximum(a, b), 0)
    out = np.zeros(len(a), np.int64)
    active = np.flatnonzero(room > 0)
    for _ in range(64):
        if not len(active):
            break
        at = out[active]
        left = np.ascontiguousarray(words[a[active] + at]).view(np.uint64).ravel()
        right = np.ascontiguousarray(words[b[active] + at]).view(np.uint64).ravel()
        differ = left ^ right
        low = differ & (~differ + np.uint64(1))
        same = np.where(differ == 0, 8, np.log2(np.maximum(low, np.uint64(1)).astype(np.float64)).astype(np.int64) // 8)
        out[active] = np.minimum(at + same, room[active])
        active = active[(differ == 0) & (out[active] < room[active])]
    for k in active.tolist():  # few share so much: each alone, in growing slices
        i, j, at, most, step = int(a[k]), int(b[k]), int(out[k]), int(room[k]), 1 << 10
        while at < most:
            size = min(step, most - at)
            differ = text[i + at:i + at + size] != text[j + at:j + at + size]
            if differ.any():
                at += int(differ.argmax())
                break
            at, step = at + size, min(2 * step, 1 << 20)
        out[k] = at
    return out
