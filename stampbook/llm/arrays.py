"""Texts of an Arrow batch as numpy arrays: words, hashes, sliding minima, packed binary columns.

Everything here works on one batch or one group inside a task; Spark partitions the work.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WORD_SEPARATORS = b" \t\n\x0b\x0c\r"

_U = np.uint64
_WRAP = 1 << 64
_BASE = _U(0x9E3779B97F4A7C15)
_SECOND = _U(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x.astype(_U, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def byte_values(lower: bool = False, seed: int = 1) -> np.ndarray:
    """A 64-bit value for each byte; with lower, A-Z get the values of a-z."""
    values = mix(np.arange(1, 257, dtype=_U) * _U(seed) + _U(seed) * _BASE) | _U(1)
    if lower:
        values[65:91] = values[97:123]
    return values


def texts(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary column and its n + 1 offsets; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks)
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(ends):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[ends[0] : ends[-1]], ends - ends[0]


def _loose_type(kind: pa.DataType) -> pa.DataType:
    if pa.types.is_struct(kind):
        return pa.struct([pa.field(f.name, _loose_type(f.type)) for f in kind])
    if pa.types.is_list(kind):
        return pa.list_(pa.field(kind.value_field.name, _loose_type(kind.value_type)))
    return kind


def loose(column: pa.Array | pa.ChunkedArray) -> pa.Array | pa.ChunkedArray:
    """A column of rows whose fields may all be null, as the type that a task's result is declared with."""
    return column.cast(_loose_type(column.type))


def slices(batch: pa.RecordBatch, column: str, size: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about so many bytes in a binary column, one row at least."""
    ends = texts(batch[column])[1]
    a = 0
    while a < batch.num_rows:
        b = max(a + 1, int(np.searchsorted(ends, ends[a] + size, "right")) - 1)
        yield batch.slice(a, b - a)
        a = b


def words(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and for each text the number of the first word in it (n + 1 entries).

    separator: for each byte whether it stands between words. A word never crosses a text's end.
    """
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = ~separator[data]
    fresh = inside.copy()
    fresh[1:] &= ~inside[:-1]
    edge = offsets[:-1][offsets[:-1] < len(data)]
    fresh[edge] = inside[edge]
    starts = np.flatnonzero(fresh)
    last = inside[:-1] & (~inside[1:] | fresh[1:])
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def separators(chars: bytes = WORD_SEPARATORS) -> np.ndarray:
    found = np.zeros(256, bool)
    found[list(chars)] = True
    return found


_STEP = 1 << 16


def _power_table(base: int, n: int) -> np.ndarray:
    out = np.full(n, base % _WRAP, _U)
    out[0] = 1
    np.multiply.accumulate(out, out=out)
    return out


_FORWARD = _power_table(int(_BASE), _STEP)
_BACKWARD = _power_table(pow(int(_BASE), -1, _WRAP), _STEP)


def prefix_sums(symbols: np.ndarray, values: np.ndarray | None = None) -> np.ndarray:
    """Prefix sums of a polynomial modulo 2^64 in the symbols (or in their values), for span_hashes."""
    sums = np.zeros(len(symbols) + 1, _U)
    factor, before, step = 1, _U(0), pow(int(_BASE), _STEP, _WRAP)
    for a in range(0, len(symbols), _STEP):
        part = symbols[a : a + _STEP] if values is None else values[symbols[a : a + _STEP]]
        out = sums[a + 1 : a + 1 + len(part)]
        np.cumsum(part * (_FORWARD[: len(part)] * _U(factor)), out=out)
        out += before
        before, factor = out[-1], factor * step % _WRAP
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of symbols, from their prefix_sums."""
    far = _power_table(pow(pow(int(_BASE), -1, _WRAP), _STEP, _WRAP), len(sums) // _STEP + 1)
    back = _BACKWARD[starts & (_STEP - 1)] * far[starts >> 16]
    return mix((sums[ends] - sums[starts]) * back + (ends - starts).astype(_U) * _SECOND)


def text_hashes(data: np.ndarray, offsets: np.ndarray, values: np.ndarray) -> np.ndarray:
    """span_hashes of neighbouring texts, some at a time."""
    out, a, n = [np.zeros(0, _U)], 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + _STEP)) - 1)
        own = offsets[a : b + 1] - offsets[a]
        out.append(span_hashes(prefix_sums(data[offsets[a] : offsets[b]], values), own[:-1], own[1:]))
        a = b
    return np.concatenate(out)


def gram_hashes(symbols: np.ndarray, k: int, base: np.uint64 = _SECOND) -> np.ndarray:
    """A 64-bit hash of each k consecutive symbols (which are 64-bit values), made by doubling."""
    if len(symbols) < k:
        return np.zeros(0, _U)
    part, size, done, out = symbols.astype(_U), 1, 0, None
    step = shift = int(base)
    while True:
        if k & size:
            if out is None:
                out, done, shift = part, size, step
            else:
                n = len(symbols) - done - size + 1
                out, done, shift = out[:n] + part[done : done + n] * _U(shift), done + size, shift * step % _WRAP
        if done == k:
            return mix(out)
        part = part[:-size] + part[size:] * _U(step)
        step, size = step * step % _WRAP, 2 * size


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each so many consecutive values, by doubling."""
    size = 1
    while 2 * size <= width:
        values = np.minimum(values[size:], values[:-size])
        size *= 2
    return np.minimum(values[width - size :], values[: size - width]) if size < width else values


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each start, one after the other."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    skip = np.repeat(starts - (np.cumsum(counts) - counts), counts)
    return skip + np.arange(total)


def gather(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The bytes of the spans, one after the other."""
    return data[ranges(starts, ends - starts)]


def covered(n: int, starts: np.ndarray, lengths: np.ndarray | int) -> np.ndarray:
    """For each of n places, whether one of the runs covers it."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + lengths, -1)
    return np.cumsum(steps[:-1]) > 0


def numbers(column: pa.ChunkedArray | pa.Array, missing: int) -> np.ndarray:
    """A column of whole numbers; a null becomes the given number."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(column.cast(pa.int64()).fill_null(missing))


def packed(array: np.ndarray) -> bytes:
    return np.ascontiguousarray(array).tobytes()
