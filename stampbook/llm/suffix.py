"""Suffix-array de-duplication over bytes.

Strings with repeated minimisers meet in a bucket (see repeats). Where different strings
share a minimiser, the bucket sorts all their suffixes that begin after white space with
the linear grouping construction, over whole pieces (a word and its white space) as
symbols. A window of 100 bytes is the rest of a piece and the beginning of such a suffix,
so equal windows are neighbours: their rests are equal, and so are the first bytes of
their suffixes, which the array and its common-prefix lengths show.
"""

from __future__ import annotations

from array import array
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stampbook.llm import arrays as A
from stampbook.llm.blocks import ROW
from stampbook.llm.columns import spread
from stampbook.llm.repeats import Sequence, Windows, judged

WINDOW_BYTES = 100
MINIMISER_BYTES = 40
BLOCK_BYTES = 2 << 20  # a byte is a symbol here, and takes more memory than a word's bytes do
_STEP = 1 << 18

_RESULT = "kept binary, n_bytes long, n_removed long, spans array<struct<start: long, end: long>>"
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """The suffix array of symbols, which end with a single smallest one.

    Phase 1 puts suffixes with the same Lyndon prefix in one group. Groups are processed in
    descending order. For each suffix of a group, the pointer to the nearest smaller suffix
    before it is found by following pointers of suffixes that are done. That suffix's prefix
    grows by the group's, so it moves to a new group right above the one it was in; suffixes
    followed by more repeats move higher. Phase 2 reads the array from its start and places,
    for each suffix, those whose next smaller suffix it is, each at the front of its group.
    """
    n = len(symbols)
    values, numbers, counts = np.unique(symbols, return_inverse=True, return_counts=True)
    group = array("i", numbers.astype(np.int32).tobytes())
    by_value = np.argsort(numbers, kind="stable")
    members = [array("i", x.astype(np.int32).tobytes()) for x in np.split(by_value, np.cumsum(counts)[:-1])]
    size = array("i", counts.astype(np.int32).tobytes())
    lower = array("i", range(-1, len(values) - 1))
    upper = array("i", [*range(1, len(values)), -1])
    done, before = bytearray(n), array("i", [-1]) * n
    g = len(values) - 1
    while g >= 0:
        own, members[g] = members[g], None  # processed once
        if len(own) != size[g]:
            own = array("i", [i for i in own if group[i] == g])
        repeats: dict[int, int] = {}
        for i in own:
            p = i - 1
            while p >= 0 and done[p]:
                p = before[p]
            if p >= 0 and group[p] == g:
                p = before[p]
            before[i] = p
            if p >= 0:
                repeats[p] = repeats.get(p, 0) + 1
        for i in own:
            done[i] = 1
        levels: dict[int, dict[int, list[int]]] = {}
        for p, k in repeats.items():
            levels.setdefault(k, {}).setdefault(group[p], []).append(p)
        for k in sorted(levels, reverse=True) if len(levels) > 1 else levels:
            for old, moved in levels[k].items():
                if len(moved) == size[old]:
                    continue
                new = len(size)
                size[old] -= len(moved)
                size.append(len(moved))
                members.append(array("i", moved))
                for p in moved:
                    group[p] = new
                above = upper[old]
                lower.append(old)
                upper.append(above)
                upper[old] = new
                if above >= 0:
                    lower[above] = new
        g = lower[g]
    front, g, at = array("i", bytes(4 * len(size))), 0, 0
    while g >= 0:
        front[g] = at
        at += size[g]
        g = upper[g]
    order, placed = array("i", [-1]) * n, bytearray(n)
    order[0] = n - 1
    placed[n - 1] = 1
    for i in range(n):
        p = order[i] - 1
        while p >= 0 and not placed[p]:
            g = group[p]
            order[front[g]] = p
            front[g] += 1
            placed[p] = 1
            p = before[p]
    return np.frombuffer(order, np.int32)


def _piece_ranks(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The rank of each piece among all by its bytes, from 1."""
    names = A.text_hashes(data, np.append(starts, len(data)), A.byte_values())
    _, which, back = np.unique(names, return_index=True, return_inverse=True)
    raw = data.tobytes()
    pieces = [raw[a:b] for a, b in zip(starts[which].tolist(), ends[which].tolist(), strict=True)]
    rank = np.empty(len(pieces), np.int64)
    rank[sorted(range(len(pieces)), key=pieces.__getitem__)] = np.arange(1, len(pieces) + 1)
    return rank[back]


def _common(data: np.ndarray, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """The number of equal bytes after places a and b, up to most."""
    out, live = np.zeros(len(a), np.int64), np.arange(len(a))
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    eight = np.lib.stride_tricks.sliding_window_view(padded, 8)
    while len(live):
        differ = eight[a[live] + out[live]] != eight[b[live] + out[live]]
        same = np.where(differ.any(1), differ.argmax(1), 8)
        out[live] += same
        live = live[(same == 8) & (out[live] < most[live])]
    return np.minimum(out, most)


def _groups(data: np.ndarray, offsets: np.ndarray, string: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """For windows (the string and the place in data), two numbers that are equal for equal windows only."""
    starts, ends, first = _pieces(data, offsets)
    suffix = np.setdiff1d(np.arange(len(starts)), first[:-1])  # a string's first piece may be the rest of one
    owner = np.searchsorted(first, suffix, "right") - 1
    ranks = _piece_ranks(data, starts, ends) + 1
    symbols = np.insert(ranks, first[1:], 1)
    place = np.arange(len(starts)) + np.repeat(np.arange(len(first) - 1), np.diff(first))
    piece_at = np.full(len(symbols) + 1, -1)
    piece_at[place[suffix]] = suffix
    order = piece_at[suffix_order(np.append(symbols, 0))]
    order = order[order >= 0]
    rank = np.full(len(starts), -1)
    rank[order] = np.arange(len(order))
    own = np.empty(len(starts), np.int64)
    own[suffix] = owner
    left = offsets[own[order] + 1] - starts[order] if len(order) else order
    same = np.zeros(len(order), np.int64)
    if len(order) > 1:
        same[1:] = _common(data, starts[order[1:]], starts[order[:-1]], np.minimum(np.minimum(left[1:], left[:-1]), length))
    sums = A.prefix_sums(data, A.byte_values())
    next_piece = np.searchsorted(starts, at, "right")  # the first to begin after the window does
    rest = np.append(starts, offsets[-1])[next_piece] - at
    within = (rest < length) & (next_piece < first[string + 1])
    major, minor = np.full(len(at), -1), np.zeros(len(at), np.uint64)
    bare = np.flatnonzero(~within)
    minor[bare] = A.span_hashes(sums, at[bare], at[bare] + length)
    inside = np.flatnonzero(within)
    minor[inside] = A.span_hashes(sums, at[inside], at[inside] + rest[inside])
    inside = inside[np.argsort(rest[inside], kind="stable")]
    sorted_rest = rest[inside]
    edges = np.flatnonzero(np.concatenate(([True], sorted_rest[1:] != sorted_rest[:-1], [True]))) if len(inside) else [0]
    for a, b in pairwise(edges):
        own_windows = inside[a:b]
        run = np.cumsum(same < length - sorted_rest[a])
        major[own_windows] = run[rank[next_piece[own_windows]]] * length + sorted_rest[a]
    return major, minor


def _pieces(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of pieces, which end after a white space byte or with the string, and each string's first."""
    blank = A.separators()[data]
    starts = np.union1d(np.flatnonzero(blank[:-1]) + 1, offsets[:-1])
    return starts, np.append(starts[1:], len(data)), np.searchsorted(starts, offsets)


def _smallest_grams(data: np.ndarray, offsets: np.ndarray, size: int) -> np.ndarray:
    """The smallest gram hash of each string, some strings at a time."""
    out, a, n, values = [], 0, len(offsets) - 1, A.byte_values()
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + _STEP)) - 1)
        own = offsets[a : b + 1] - offsets[a]
        grams = np.append(A.gram_hashes(values[data[offsets[a] : offsets[b]]], size), ~np.uint64(0))
        out.append(np.minimum.reduceat(grams, np.stack((own[:-1], own[1:] - size + 1), 1).ravel())[::2])
        a = b
    return np.concatenate(out)


def _earlier(length: int, minimiser: int):
    def earlier(data: np.ndarray, offsets: np.ndarray, ids: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        counts = np.diff(offsets) - length + 1
        names = A.text_hashes(data, offsets, A.byte_values())
        by_place = np.lexsort((places, ids, names))
        fresh = np.append(True, names[by_place][1:] != names[by_place][:-1])
        text = np.empty(len(names), np.int64)
        text[by_place] = np.cumsum(fresh) - 1
        lead = by_place[fresh]  # of each distinct string, its first place
        least_id, least_place = ids[lead], places[lead]
        upto = np.concatenate(([0], np.cumsum(counts[lead])))

        # distinct strings, one after the other, and which of them share their minimiser with another
        size = np.diff(offsets)[lead]
        own = A.gather(data, offsets[:-1][lead], offsets[1:][lead])
        own_offsets = np.concatenate(([0], np.cumsum(size)))
        smallest = _smallest_grams(own, own_offsets, minimiser)
        _, back, often = np.unique(smallest, return_inverse=True, return_counts=True)
        mixed = np.flatnonzero(often[back] > 1)

        window_id, window_place = np.repeat(least_id, counts[lead]), A.ranges(least_place, counts[lead])
        if len(mixed):
            string = np.repeat(np.arange(len(mixed)), counts[lead][mixed])
            some = A.gather(own, own_offsets[:-1][mixed], own_offsets[1:][mixed])
            some_offsets = np.concatenate(([0], np.cumsum(size[mixed])))
            at = A.ranges(some_offsets[:-1], counts[lead][mixed])
            major, minor = _groups(some, some_offsets, string, at, length)
            where = A.ranges(upto[:-1][mixed], counts[lead][mixed])
            owner, start = window_id[where], window_place[where]
            order = np.lexsort((start, owner, minor, major))
            new = np.append(True, (major[order][1:] != major[order][:-1]) | (minor[order][1:] != minor[order][:-1]))
            head = order[new][np.cumsum(new) - 1]
            window_id[where[order]], window_place[where[order]] = owner[head], start[head]
        each = A.ranges(upto[:-1][text], counts)
        mine, begin = np.repeat(ids, counts), A.ranges(places, counts)
        return (window_id[each] < mine) | ((window_id[each] == mine) & (window_place[each] < begin)), counts

    return earlier


def _read(data: np.ndarray, offsets: np.ndarray) -> Sequence:
    return Sequence(data, data, offsets, values=A.byte_values())


def _result(table: pa.Table, seq: Sequence, gone: np.ndarray) -> pa.Table:
    n = len(seq.first) - 1
    total = np.concatenate(([0], np.cumsum(gone)))
    removed = total[seq.first[1:]] - total[seq.first[:-1]]
    padded = np.concatenate(([False], gone, [False]))
    edge = np.zeros(len(gone) + 1, bool)
    edge[seq.first] = True
    begin = np.flatnonzero(padded[1:] & (~padded[:-1] | edge))[: None if len(gone) else 0]
    end = np.flatnonzero(padded[:-1] & (~padded[1:] | edge))
    text = np.searchsorted(seq.first, begin, "right") - 1
    spans = pa.StructArray.from_arrays([pa.array(begin - seq.first[text]), pa.array(end - seq.first[text])], ["start", "end"])
    raw = seq.data[~gone].tobytes()
    upto = (seq.first - total[seq.first]).tolist()
    kept = pa.array([raw[a:b] for a, b in zip(upto[:-1], upto[1:], strict=True)], pa.binary())
    lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(text, np.arange(n + 1)), pa.int32()), spans)
    return pa.table({ROW: A.loose(table[ROW]), "kept": kept, "n_bytes": np.diff(seq.first), "n_removed": removed, "spans": lists})


def remove_repeated_bytes(docs: DataFrame, window: int = WINDOW_BYTES, minimiser: int = MINIMISER_BYTES) -> DataFrame:
    """All columns of docs but text, and kept (the remaining bytes), n_bytes, n_removed, spans (removed byte runs).

    Texts are UTF-8 bytes. Each byte goes that is covered by a string of ``window`` bytes that also starts
    earlier: in a document with a smaller doc_id, or earlier in the same one. Nulls and empty texts have no
    bytes and no spans. A missing doc_id counts as larger than all others; rows with the same doc_id count as
    one document, in which equal places are not earlier than one another. An empty table gives no rows.
    Extra columns pass through, whatever their names.
    """
    if not 0 < minimiser <= window:
        raise ValueError("a minimiser has at least one byte and at most a window's")
    arrow = pa.schema([(ROW, pa.null()), ("kept", pa.binary()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("spans", _SPANS)])
    out = judged(docs, Windows(window, minimiser, True, _read, _earlier(window, minimiser)), _result, _RESULT, arrow, BLOCK_BYTES)
    return spread(out, ROW, "kept", "n_bytes", "n_removed", "spans")


def op3(docs: DataFrame) -> DataFrame:
    found = remove_repeated_bytes(docs.select("doc_id", "text"))
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
