"""Vectorised hashing of many texts at once (numpy over one Arrow batch).

The texts of a batch are laid end to end as one byte array; words, rolling
hashes and window minima are then computed for the whole batch with a fixed
number of array passes, so cost is a few nanoseconds a byte and memory is a
fixed multiple of the batch's bytes.
"""

from __future__ import annotations

import ctypes
import sys

import numpy as np
import pyarrow as pa

U64 = np.uint64
# Odd multipliers of the polynomial hashes (any odd numbers do).
BASES = (U64(0x9E3779B97F4A7C15), U64(0xD1B54A32D192ED03))
_MIX = U64(0xFF51AFD7ED558CCD)


_LIBC = ctypes.CDLL(None) if sys.platform == "linux" else None


def trim() -> None:
    """Gives memory that is free back to the system: Python workers wait for
    other tasks between theirs, beside the JVM."""
    pa.default_memory_pool().release_unused()
    if hasattr(_LIBC, "malloc_trim"):
        _LIBC.malloc_trim(0)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the entropy of 64-bit values over all bits."""
    h = h ^ (h >> U64(33))
    h = h * _MIX
    return h ^ (h >> U64(29))


def _byte_codes(seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 2**63, 256, dtype=np.uint64) * U64(2) + U64(1)


BYTE_CODES = _byte_codes(1)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: \x20 and \x09-\x0D separate words.
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True


def batch_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts end to end, offsets of len+1); a null text is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type):
        width = np.int64
    else:
        width = np.int32
    n = len(col)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    bufs = col.buffers()
    offs = np.frombuffer(bufs[1], width, n + 1 + col.offset)[col.offset :].astype(np.int64)
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    data = data[offs[0] : offs[-1]]
    offs = offs - offs[0]
    if col.null_count:
        null = np.asarray(col.is_null())
        if (np.diff(offs)[null] != 0).any():  # nulls may hide bytes
            return batch_bytes(col.fill_null("" if not pa.types.is_binary(col.type) else b""))
    return data, offs


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.empty(n, U64)
    if n:
        out[0] = 1
        filled = 1
        step = base
        while filled < n:
            m = min(filled, n - filled)
            out[filled : filled + m] = out[:m] * step
            filled += m
            step = U64(int(step) ** 2 % 2**64)
    return out


class Rolling:
    """Polynomial hashes modulo 2**64 of any spans of one token sequence. Long
    structured spans can collide, so they only choose places (anchors) or
    features; what must be equal is compared by Field."""

    def __init__(self, codes: np.ndarray, base: np.uint64 = BASES[0]):
        n = len(codes)
        inverse = U64(pow(int(base), -1, 2**64))
        self.inv = powers(inverse, n + 1)
        self.prefix = np.zeros(n + 1, U64)
        np.cumsum(codes * powers(base, n), out=self.prefix[1:])

    def spans(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        return mix((self.prefix[hi] - self.prefix[lo]) * self.inv[lo])

    def grams(self, k: int) -> np.ndarray:
        """Hash of the k tokens from each position on (len - k + 1 of them)."""
        if len(self.prefix) <= k:
            return np.zeros(0, U64)
        return mix((self.prefix[k:] - self.prefix[: len(self.prefix) - k]) * self.inv[: len(self.prefix) - k])


PRIME = (1 << 61) - 1
#: Bases of the prime-field hashes: any two different numbers below PRIME, drawn once.
FIELD_BASES = (1_402_364_718_690_412_853, 1_873_501_229_474_067_421)
_P, _S61, _S31, _S30 = U64(PRIME), U64(61), U64(31), U64(30)
_M31, _M30 = U64((1 << 31) - 1), U64((1 << 30) - 1)
#: Sums of this many products of a byte and 31 bits stay below 2**63.
_RUN = 1 << 23


def _reduced(x: np.ndarray) -> np.ndarray:
    x = (x & _P) + (x >> _S61)
    return np.where(x >= _P, x - _P, x)


def _shifted31(x: np.ndarray) -> np.ndarray:
    """x * 2**31 modulo PRIME, not yet fully reduced; x below PRIME."""
    return (x >> _S30) + ((x & _M30) << _S31)


def mulmod(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a * b modulo PRIME, both below PRIME, in four products of halves."""
    ah, al, bh, bl = a >> _S31, a & _M31, b >> _S31, b & _M31
    middle = ah * bl + al * bh
    return _reduced(((ah * bh) << U64(1)) + _shifted31(middle) + al * bl)


_POWERS: dict[int, np.ndarray] = {}


def field_powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo PRIME; kept for the next batch."""
    known = _POWERS.get(base)
    if known is None or len(known) < n:
        out = np.ones(max(n, 1 << 16), U64)
        filled, step = 1, base
        while filled < len(out):
            m = min(filled, len(out) - filled)
            out[filled : filled + m] = mulmod(out[:m], U64(step))
            filled += m
            step = step * step % PRIME
        known = out
        if n <= 1 << 21:
            _POWERS[base] = known
    return known[:n]


class Field:
    """Polynomial hashes of spans over the field of 2**61 - 1 elements. Two
    different spans of n tokens have one hash for at most n of the 2**61 bases,
    whatever the tokens are, unlike hashes modulo a power of two. `which`
    chooses one of two independent bases."""

    def __init__(self, codes: np.ndarray, which: int = 0):
        base, n = FIELD_BASES[which], len(codes)
        self.inverse = field_powers(pow(base, -1, PRIME), n + 1)
        power = field_powers(base, n)
        self.high, self.low = np.zeros(n + 1, U64), np.zeros(n + 1, U64)
        for a in range(0, n, _RUN):
            own = slice(a, min(a + _RUN, n))
            if codes.dtype == np.uint8:
                code = codes[own].astype(U64) + U64(1)  # no code is 0, so length counts
                high, low = code * (power[own] >> _S31), code * (power[own] & _M31)
            else:
                product = mulmod(codes[own], power[own])
                high, low = product >> _S31, product & _M31
            for sums, part in ((self.high, high), (self.low, low)):
                np.cumsum(part, out=sums[a + 1 : own.stop + 1])
                if a:
                    sums[a + 1 : own.stop + 1] += sums[a] % _P

    def spans(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Hashes below PRIME, never 0 for tokens that are never 0 modulo PRIME and n > 0, but for chance."""
        part = lambda sums: _reduced(_reduced(sums[hi]) + (_P - _reduced(sums[lo])))
        return mulmod(_reduced(_shifted31(part(self.high)) + part(self.low)), self.inverse[lo])


def words(data: np.ndarray, offs: np.ndarray, separator: np.ndarray = SPACE):
    """(start, end, first word of each text [len+1]) of the maximal runs of non-separators; no run crosses texts."""
    n = len(data)
    inside = ~separator[data]
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    cuts = offs[:-1]
    cuts = cuts[cuts < n]
    begin[cuts] = inside[cuts]
    stop = inside.copy()
    stop[:-1] &= ~inside[1:]
    last = offs[1:] - 1
    last = last[last >= 0]
    stop[last] = inside[last]
    starts = np.flatnonzero(begin)
    ends = np.flatnonzero(stop) + 1
    return starts, ends, np.searchsorted(starts, offs)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of `width` values, by block prefix and suffix minima."""
    n = len(values)
    if n < width:
        return np.zeros(0, values.dtype)
    if width == 1:
        return values
    pad = -n % width
    padded = np.concatenate([values, np.full(pad, np.iinfo(values.dtype).max, values.dtype)]).reshape(-1, width)
    left = np.minimum.accumulate(padded, axis=1).ravel()
    right = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[: n - width + 1], left[width - 1 : n])


def owners(firsts: np.ndarray) -> np.ndarray:
    """Text index of each item, from the first item of each text [len+1]."""
    return np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))
