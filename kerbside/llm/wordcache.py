"""Split many texts into pieces with numpy and work out each distinct piece once."""

import numpy as np

MASK = (1 << 64) - 1
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)

#: Bytes that a cache holds before it starts anew.
CACHE_BYTES = 40 << 20


def mix(x):
    """A bijective scramble of 64-bit words (the finaliser of splitmix64)."""
    x = np.asarray(x, np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base, n):
    out = np.empty(n, np.uint64)
    out[0] = 1
    done = 1
    while done < n:
        step = min(done, n - done)
        out[done:done + step] = out[:step] * np.uint64(pow(base, done, 1 << 64))
        done += step
    return out


_tables = {}


def _power_table(n):
    """Powers of BASE and of its inverse, at least ``n`` of each; grown by doubling."""
    if _tables.get("n", 0) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        _tables.update(n=size, up=_powers(BASE, size), down=_powers(INVERSE, size))
    return _tables["up"], _tables["down"]


def piece_hashes(codes, starts, ends):
    """64-bit hashes of ``codes[start:end]``; ``codes`` are integers."""
    up, down = _power_table(len(codes) + 1)
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(mix(codes.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)) * up[:len(codes)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


class WordCache:
    """Numbers distinct pieces. ``add(codes, starts, ends)`` gets the new ones of a chunk, once each.

    Hashes stand in a sorted array. ``clear()`` is called when they and what ``kept()`` says that the owner keeps for
    them are past ``limit`` bytes, so memory stays bounded however many distinct pieces a task meets.
    """

    def __init__(self, add, clear, kept, limit=CACHE_BYTES):
        self.add, self.clear, self.kept, self.limit = add, clear, kept, limit
        self._empty()

    def _empty(self):
        self.hashes, self.at = np.zeros(0, np.uint64), np.zeros(0, np.int32)

    def numbers(self, codes, starts, ends):
        """The number of each piece ``codes[start:end]``, in the order of addition since the last clear."""
        if self.hashes.nbytes + self.at.nbytes + self.kept() > self.limit:
            self._empty()
            self.clear()
        hashes, first, inverse = np.unique(piece_hashes(codes, starts, ends), return_index=True, return_inverse=True)
        place = np.searchsorted(self.hashes, hashes)
        numbers = np.full(len(hashes), -1, np.int64)
        near = np.minimum(place, max(0, len(self.hashes) - 1))
        if len(self.hashes):
            same = self.hashes[near] == hashes
            numbers[same] = self.at[near[same]]
        new = np.flatnonzero(numbers < 0)
        if len(new):
            numbers[new] = np.arange(len(self.hashes), len(self.hashes) + len(new))
            self.hashes, self.at = np.insert(self.hashes, place[new], hashes[new]), np.insert(self.at, place[new], numbers[new])
            self.add(codes, starts[first[new]], ends[first[new]])
        return numbers[inverse]


def gather(flat, offsets, lengths, chosen):
    """The stretches ``flat[offsets[i]:offsets[i] + lengths[i]]`` of all ``i`` in ``chosen``, one after the other."""
    width = lengths[chosen]
    ends = np.cumsum(width)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat(offsets[chosen] - (ends - width), width) + np.arange(total)]


class Flat:
    """A growing list of integer stretches, held as one array."""

    def __init__(self, kind=np.int32):
        self.kind, self.parts, self.widths = kind, [], []

    def extend(self, values, widths):
        self.parts.append(np.asarray(values, self.kind))
        self.widths.append(np.asarray(widths, np.int32))

    @property
    def nbytes(self):
        return sum(a.nbytes for held in (self.parts, self.widths) for a in held)

    def arrays(self):
        """``(flat, offsets, widths)``"""
        for name in ("parts", "widths"):
            held = getattr(self, name)
            if len(held) != 1:
                setattr(self, name, [np.concatenate(held)] if held else [np.zeros(0, self.kind if name == "parts" else np.int32)])
        widths = self.widths[0].astype(np.int64)
        return self.parts[0], np.cumsum(widths) - widths, widths


def code_points(text):
    return np.frombuffer(text.encode("utf-32-le"), "<u4")
