"""Vectorised hashes of all windows of an integer sequence, and sliding minima."""

from __future__ import annotations

import numpy as np

#: Hashes are polynomials modulo this prime, 2**61 - 1, at a fixed random base.
PRIME = (1 << 61) - 1
BASE = 0x0F6C1B7A93D5E248
LOW = 1 << 14
_powers: dict[tuple[int, bool], tuple[np.ndarray, np.ndarray]] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """Scatter the bits of uint64 values (a bijection), in place."""
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def _reduced(x: np.ndarray) -> np.ndarray:
    """``x`` (uint64) modulo the prime."""
    x = (x & np.uint64(PRIME)) + (x >> np.uint64(61))
    return np.where(x >= np.uint64(PRIME), x - np.uint64(PRIME), x)


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a * b modulo the prime, for values below it: products of halves of 31 bits, where 2**61 counts as 1."""
    half, low = np.uint64(31), np.uint64((1 << 31) - 1)
    a1, a0, b1, b0 = a >> half, a & low, b >> half, b & low
    middle = a1 * b0
    middle += a0 * b1
    out = a1 * b1
    out <<= np.uint64(1)
    out += middle >> np.uint64(30)
    middle &= np.uint64((1 << 30) - 1)
    middle <<= half
    out += middle
    out += a0 * b0
    return _reduced(out)


def _running(unit: int, n: int) -> np.ndarray:
    """unit ** 0 ... unit ** (n - 1), by doubling."""
    out = np.ones(1, np.uint64)
    while len(out) < n:
        out = np.concatenate([out, times(out, np.full(1, pow(unit, len(out), PRIME), np.uint64))])
    return out[:n]


def _power_tables(base: int, inverse: bool, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base ** (LOW * i) and base ** j (or their inverses): two small tables whose products are the powers below n."""
    coarse, fine = _powers.get((base, inverse), (np.zeros(0, np.uint64), None))
    if fine is None or len(coarse) * LOW < n:
        unit = pow(base, -1, PRIME) if inverse else base
        fine = _running(unit, LOW) if fine is None else fine
        coarse = _running(pow(unit, LOW, PRIME), max(n // LOW + 1, 2 * len(coarse)))
        _powers[base, inverse] = coarse, fine
    return coarse, fine


def _scale(values: np.ndarray, base: int, inverse: bool) -> np.ndarray:
    """Multiply each value (below the prime) by the power (or its inverse) of its
    position, in place, a cached piece at a time."""
    coarse, fine = _power_tables(base, inverse, len(values))
    half, third, low, rest = np.uint64(31), np.uint64(30), np.uint64((1 << 31) - 1), np.uint64((1 << 30) - 1)
    prime, top = np.uint64(PRIME), np.uint64(61)
    fine1, fine0 = fine >> half, fine & low
    a1, a0, x, y, z = (np.empty(LOW, np.uint64) for _ in range(5))

    def by(a, b1, b0, n):  # a *= b, up to one multiple of the prime; as ``times``, without new arrays
        h, l, m, o, t = a1[:n], a0[:n], x[:n], y[:n], z[:n]
        np.right_shift(a, half, out=h)
        np.bitwise_and(a, low, out=l)
        np.multiply(h, b0, out=m)
        np.multiply(l, b1, out=t)
        np.add(m, t, out=m)
        np.multiply(h, b1, out=o)
        np.left_shift(o, 1, out=o)
        np.multiply(l, b0, out=t)
        np.add(o, t, out=o)
        np.right_shift(m, third, out=t)
        np.add(o, t, out=o)
        np.bitwise_and(m, rest, out=m)
        np.left_shift(m, half, out=m)
        np.add(o, m, out=o)
        np.right_shift(o, top, out=t)
        np.bitwise_and(o, prime, out=o)
        np.add(o, t, out=a)

    for k in range(0, len(values), LOW):
        part = values[k:k + LOW]
        n = len(part)
        by(part, fine1[:n], fine0[:n], n)
        c = int(coarse[k // LOW])
        if c != 1:
            by(part, np.uint64(c >> 31), np.uint64(c & ((1 << 31) - 1)), n)
        _under(part, z[:n])
    return values


def _under(part: np.ndarray, scratch: np.ndarray) -> None:
    """Take the prime off values that reach it, in place."""
    np.add(part, 1, out=scratch)
    np.right_shift(scratch, np.uint64(61), out=scratch)
    np.add(part, scratch, out=part)
    np.bitwise_and(part, np.uint64(PRIME), out=part)


def _sums(values: np.ndarray) -> np.ndarray:
    """Running sums modulo the prime, in place, a cached piece at a time; halves
    are summed apart so that nothing overflows."""
    third, rest, prime, top = np.uint64(30), np.uint64((1 << 30) - 1), np.uint64(PRIME), np.uint64(61)
    carry, high = 0, np.empty(LOW, np.uint64)
    for k in range(0, len(values), LOW):
        part = values[k:k + LOW]
        h = high[:len(part)]
        np.right_shift(part, third, out=h)
        np.cumsum(h, out=h)  # below 2**43
        np.bitwise_and(part, rest, out=part)
        part[0] += np.uint64(carry)
        np.cumsum(part, out=part)  # below 2**62
        part += h >> np.uint64(31)  # with the next line: h * 2**30
        h <<= third
        h &= prime
        part += h
        np.right_shift(part, top, out=h)
        part &= prime
        part += h
        _under(part, h)
        carry = int(part[-1])
    return values


class Windows:
    """Hashes of the windows of one sequence: a polynomial modulo 2**61 - 1, mixed.

    Equal windows have equal hashes wherever they are. Two different windows of
    n values collide with a probability of n / 2**61 over the choice of base, whatever
    their structure; callers that need more take a second ``base``.
    """

    def __init__(self, values: np.ndarray, base: int = BASE):
        self.base = base
        self.sums = np.zeros(len(values) + 1, np.uint64)
        scaled = self.sums[1:]
        scaled[:] = values
        if values.dtype.itemsize > 4:
            scaled[:] = _reduced(scaled)
            scaled[scaled == np.uint64(PRIME - 1)] = 0
        scaled += np.uint64(1)
        _sums(_scale(scaled, base, False))

    def _between(self, starts, ends) -> np.ndarray:
        a, h = self.sums[starts], self.sums[ends]
        h = h - a  # wraps where the later sum is smaller
        h += (h >> np.uint64(63)) * np.uint64(PRIME)
        return h

    def all(self, length: int) -> np.ndarray:
        """Hash of [i, i + length) for each i where it fits."""
        n = len(self.sums) - length
        if n <= 0:
            return np.zeros(0, np.uint64)
        return mix(_scale(self._between(slice(0, n), slice(length, None)), self.base, True))

    def at(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of [start, end) for given positions; the length takes part."""
        coarse, fine = _power_tables(self.base, True, len(self.sums))
        h = times(times(self._between(starts, ends), coarse[starts // LOW]), fine[starts % LOW])
        h += (ends - starts).astype(np.uint64) * np.uint64(0xA0761D6478BD642F)
        return mix(h)


def short_hashes(data: np.ndarray, length: int) -> np.ndarray:
    """Hash (uint32) of each window of 1 to 16 bytes, from its first and its last
    power of two of bytes. Different windows can share one, so this is for
    choices that may be any function of the window's bytes."""
    n = len(data) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint32)
    span = min(8, 1 << (length.bit_length() - 1))
    words = _words(data, span).astype(np.uint64)
    h = words[:n] * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(32)
    if length > span:
        h += words[length - span:]
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0x9FB21C651E98DF25)
    return (h >> np.uint64(32)).astype(np.uint32)


def sparse_hashes(data: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """Hash of the ``length`` bytes (4 or more) at each position of ``at``: two
    sums of its 32-bit words times fixed random numbers, the upper half of each.
    For positions far apart, where this costs less than hashes of all windows."""
    words = _words(data, 4)
    places = [*range(0, length - 3, 4)] + [length - 4] * (length % 4 > 0)
    factors = mix(np.arange(1, 2 * len(places) + 1, dtype=np.uint64) * np.uint64(BASE)) | np.uint64(1)
    one, two = np.zeros((2, len(at)), np.uint64)
    for k, place in enumerate(places):
        word = words[at + place].astype(np.uint64) + np.uint64(1)
        one += word * factors[2 * k]
        two += word * factors[2 * k + 1]
    return one >> np.uint64(32) | two >> np.uint64(32) << np.uint64(32)


def _words(data: np.ndarray, span: int) -> np.ndarray:
    """The ``span`` (1, 2, 4 or 8) bytes at each position where they fit, as a number."""
    data = np.ascontiguousarray(data, np.uint8)
    return np.ndarray(max(len(data) - span + 1, 0), f"<u{span}", data, strides=(1,)).copy()


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of values[i:i + width] for each i where it fits (doubling)."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    low, span = values, 1
    while 2 * span <= width:
        low = np.minimum(low[:len(low) - span], low[span:])
        span *= 2
    return np.minimum(low[:n], low[width - span:width - span + n])


def closed_syncmers(inner: np.ndarray, width: int) -> np.ndarray:
    """Whether the window of ``width`` inner hashes that starts at i has its
    minimum first or last: a choice that depends on the window alone."""
    low = sliding_min(inner, width)
    n = len(low)
    return (inner[:n] == low) | (inner[width - 1:width - 1 + n] == low)
