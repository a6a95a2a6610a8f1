"""Words of many texts at once, as spans of one byte array, and hashes of spans by position tables."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

BATCH_BYTES = 1 << 22
SPAN_BYTES = 1 << 20
REACH = 64  # distances from the end of a span that the tables know

# A-Z become a-z; letters, digits and all bytes beyond ASCII belong to words
LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[65:91] += 32
IN_WORD = np.zeros(256, bool)
IN_WORD[48:58] = IN_WORD[65:91] = IN_WORD[97:123] = IN_WORD[128:] = True
NO_BLANK = np.ones(256, bool)
NO_BLANK[9:14] = NO_BLANK[32] = False


def texts(column: pa.Array, most: int = BATCH_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Parts of a text column: first row, bytes and the offsets of its rows.

    A part has at most ``most`` bytes or is a single text. Nulls are empty.
    """
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    body = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + most, "right")) - 1)
        yield lo, body[at[lo] : at[hi]], at[lo : hi + 1] - at[lo]
        lo = hi


def word_spans(
    body: np.ndarray, offsets: np.ndarray, letters: np.ndarray = IN_WORD
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and length of every run of ``letters`` and the runs per text; none crosses two texts."""
    inside = letters[body]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(body))]
    first[edges] = inside[edges]
    last[edges - 1] = inside[edges - 1]
    starts = np.flatnonzero(first)
    lengths = np.flatnonzero(last) + 1 - starts
    bounds = np.searchsorted(starts, offsets)
    return starts, lengths, np.diff(bounds)


def runs(body: np.ndarray, starts: np.ndarray, lengths: np.ndarray, counts: np.ndarray, size: int):
    """The spans of all runs of ``size`` words of a text, over words joined by one space.

    Returns the joined bytes, start and length of every run and the runs per text.
    """
    if size == 1:
        return body, starts, lengths, counts
    total = int(lengths.sum()) + len(lengths)
    joined = np.full(total, 32, np.uint8)
    begin = np.cumsum(lengths + 1) - lengths - 1
    hold = np.arange(total - len(lengths)) + np.repeat(np.arange(len(lengths)), lengths)
    from_ = np.repeat(starts - begin, lengths) + hold
    joined[hold] = body[from_]
    if len(lengths) < size:
        none = np.zeros(0, np.int64)
        return joined, none, none, np.zeros_like(counts)
    text = np.repeat(np.arange(len(counts)), counts)
    whole = text[: len(text) - size + 1] == text[size - 1 :]
    at = np.flatnonzero(whole)
    end = begin[at + size - 1] + lengths[at + size - 1]
    return joined, begin[at], end - begin[at], np.maximum(counts - size + 1, 0)


def crc_table() -> np.ndarray:
    """The register after one byte, from zero (CRC-32, reflected)."""
    reg = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        reg = np.where(reg & np.uint32(1), (reg >> np.uint32(1)) ^ np.uint32(0xEDB88320), reg >> np.uint32(1))
    return reg.astype(np.uint32)


class Crc:
    """CRC-32 of many spans at once.

    The register is linear in the bytes: each byte adds, by exclusive or, a share that depends
    on its value and its distance from the end of the span, and the length adds a constant.
    Spans beyond ``REACH`` bytes are cut into blocks counted from their end, and the register
    of the blocks so far is moved on by ``REACH`` bytes before the next is added.
    """

    def __init__(self):
        step = crc_table()
        self.by_place = np.empty((REACH, 256), np.uint32)
        self.by_place[0] = step
        for d in range(1, REACH):
            before = self.by_place[d - 1]
            self.by_place[d] = step[before & np.uint32(255)] ^ (before >> np.uint32(8))
        self.flat = self.by_place.ravel()
        self.start = np.empty(REACH + 1, np.uint32)  # the first register after so many zero bytes
        self.start[0] = 0xFFFFFFFF
        for n in range(1, REACH + 1):
            before = self.start[n - 1]
            self.start[n] = step[before & np.uint32(255)] ^ (before >> np.uint32(8))
        ahead = [np.arange(256, dtype=np.uint32) << np.uint32(8 * k) for k in range(4)]
        for _ in range(REACH):
            ahead = [step[a & np.uint32(255)] ^ (a >> np.uint32(8)) for a in ahead]
        self.ahead = ahead

    def moved_on(self, reg: np.ndarray) -> np.ndarray:
        out = self.ahead[0][reg & np.uint32(255)]
        for k in range(1, 4):
            out = out ^ self.ahead[k][(reg >> np.uint32(8 * k)) & np.uint32(255)]
        return out

    def __call__(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The CRC-32 of ``data[start : start + length]`` for every span of at least one byte."""
        parts = (lengths + REACH - 1) // REACH
        head = lengths - (parts - 1) * REACH  # bytes of the first block
        if not len(parts) or parts.max() == 1:
            return _folded(self.flat, data, starts, lengths) ^ self.start[lengths] ^ np.uint32(0xFFFFFFFF)
        first = np.cumsum(parts) - parts
        nth = np.arange(int(parts.sum())) - np.repeat(first, parts)
        own_head = np.repeat(head, parts)
        at = np.repeat(starts, parts) + np.where(nth, own_head + (nth - 1) * REACH, 0)
        share = _folded(self.flat, data, at, np.where(nth, REACH, own_head))
        reg = share[first] ^ self.start[head]
        going, k = np.flatnonzero(parts > 1), 1
        while len(going):
            reg[going] = self.moved_on(reg[going]) ^ share[first[going] + k]
            k += 1
            going = going[parts[going] > k]
        return reg ^ np.uint32(0xFFFFFFFF)


def _folded(flat: np.ndarray, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Per span the exclusive or of ``flat[256 * distance from the end + byte]``; lengths are 1 to ``REACH``."""
    out = np.empty(len(starts), flat.dtype)
    ends = np.cumsum(lengths)
    lo = 0
    while lo < len(starts):
        base = int(ends[lo - 1]) if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, base + SPAN_BYTES, "right")))
        size, stop = lengths[lo:hi], ends[lo:hi] - base
        place = np.arange(int(stop[-1]), dtype=np.int32)
        byte = data[place + np.repeat((starts[lo:hi] - stop + size), size)]
        left = np.repeat((stop - 1).astype(np.int32), size) - place
        out[lo:hi] = np.bitwise_xor.reduceat(flat[(left << 8) + byte], stop - size)
        lo = hi
    return out


class SpanHash:
    """64-bit hashes of many spans: a random number per byte and distance from the end, joined by
    exclusive or; spans beyond ``REACH`` bytes one by one."""

    def __init__(self, seed: int = 0):
        self.flat = np.random.default_rng(seed).integers(0, 1 << 64, REACH * 256, np.uint64)

    def __call__(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        out = _folded(self.flat, data, starts, np.minimum(lengths, REACH))
        for i in np.flatnonzero(lengths > REACH).tolist():
            out[i] = xxhash.xxh64_intdigest(data[starts[i] : starts[i] + lengths[i]].tobytes(), 42)
        return out


class Terms:
    """Places of many spans in a fixed list of terms.

    Spans are found by their :class:`SpanHash` and compared byte by byte with the term they meet.
    """

    def __init__(self, terms: list[bytes]):
        for seed in range(64):
            self.hashes = SpanHash(seed)
            lengths = np.array([len(t) for t in terms], np.int64)
            starts = np.cumsum(lengths) - lengths
            body = np.frombuffer(b"".join(terms), np.uint8)
            own = self.hashes(body, starts, lengths)
            order = np.argsort(own, kind="stable")
            if not (own[order][1:] == own[order][:-1]).any():
                break
        else:
            raise ValueError("the list repeats a term")
        self.order, self.sorted = order, own[order]
        self.body, self.starts, self.lengths = body, starts, lengths

    def places(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Per span the number of its term, -1 if it is none."""
        if not len(self.order) or not len(starts):
            return np.full(len(starts), -1, np.int64)
        own = self.hashes(data, starts, lengths)
        at = np.minimum(np.searchsorted(self.sorted, own), len(self.order) - 1)
        term = self.order[at]
        hit = np.flatnonzero((self.sorted[at] == own) & (self.lengths[term] == lengths))
        out = np.full(len(starts), -1, np.int64)
        ends, lo = np.cumsum(lengths[hit]), 0
        while lo < len(hit):
            base = int(ends[lo - 1]) if lo else 0
            hi = max(lo + 1, int(np.searchsorted(ends, base + SPAN_BYTES, "right")))
            some = hit[lo:hi]
            size, stop = lengths[some], ends[lo:hi] - base
            place = np.arange(int(stop[-1]))
            same = data[place + np.repeat(starts[some] - stop + size, size)] == self.body[
                place + np.repeat(self.starts[term[some]] - stop + size, size)
            ]
            equal = np.logical_and.reduceat(same, stop - size)
            out[some[equal]] = term[some[equal]]
            lo = hi
        return out
