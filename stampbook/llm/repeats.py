"""Windows of k symbols that also start earlier, found without moving the windows themselves.

Each window belongs to the smallest m-gram hash (minimiser) in it; equal windows have
equal minimisers. Consecutive windows with the same minimiser form one run.

1. Each block sends the hashes of its minimisers, once each, to buckets dealt by hash;
   a bucket answers with one bit for each: seen in more than one place.
2. Runs of repeated minimisers travel as one packed string each to the bucket of their
   minimiser. Equal strings of a block travel once, with their first place, so a passage
   that a third of all documents share adds one string a block.
3. The bucket finds equal windows of different strings (sorting or a suffix array, as the
   operator says) and answers with one bit for each window: starts earlier elsewhere.
4. Each block sets the bits on its own texts.

Nothing is capped: every window is judged. Bits of steps 1 and 3 are all that comes back.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stampbook.llm import arrays as A
from stampbook.llm.blocks import BLOCK, BLOCK_BYTES, ID, TEXT, blocked, parts, text_bytes

ASK = "bucket int, block int, keys binary, multi binary"
ANSWER = "block int, kind int, bucket int, bits binary"
STRETCH = 4  # bytes of strings, if all are repeated, for each byte of text
_CHUNK = 1 << 15  # symbols whose hashes fit in a core's cache
SENT = "bucket int, block int, data binary, ends binary, ids binary, places binary"


@dataclass
class Sequence:
    """The symbols of a block's texts, one text after the other, and where they are in the bytes."""

    data: np.ndarray
    symbols: np.ndarray  # 64-bit values, or numbers of values
    first: np.ndarray  # number of the first symbol of each text, n + 1 entries
    starts: np.ndarray | None = None  # of the symbols in data; None: a symbol is a byte
    ends: np.ndarray | None = None
    values: np.ndarray | None = None

    def part(self, a: int, b: int) -> np.ndarray:
        return self.symbols[a:b] if self.values is None else self.values[self.symbols[a:b]]

    def bytes_of(self, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Byte spans of runs of symbols first..last."""
        return (first, last + 1) if self.starts is None else (self.starts[first], self.ends[last])


@dataclass
class Runs:
    keys: np.ndarray  # the minimiser's hash
    text: np.ndarray  # number of the text
    window: np.ndarray  # number of the first window's first symbol
    count: np.ndarray  # of windows


@dataclass(frozen=True)
class Windows:
    """What a repeat is. read: bytes and offsets of texts to a Sequence. earlier: in a bucket, the strings'
    bytes, byte offsets, ids and places to one bit for each window of each string. own_text: whether an
    earlier start in the same text counts."""

    length: int
    minimiser: int
    own_text: bool
    read: Callable[[np.ndarray, np.ndarray], Sequence]
    earlier: Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], np.ndarray]

    def runs(self, seq: Sequence) -> Runs:
        """Runs of windows with the same smallest gram (the first, if several are); a run ends with its text.

        No two windows of a run are equal: equal ones would have their smallest gram at the same offset.
        """
        changes, keys = [], []
        for a in range(0, len(seq.symbols) - self.length + 1, _CHUNK):
            grams = A.gram_hashes(seq.part(a, a + _CHUNK + self.length), self.minimiser)
            least = A.sliding_min(grams, self.length - self.minimiser + 1)
            at = np.flatnonzero((least[1:] != least[:-1]) | (grams[: len(least) - 1] == least[:-1])) + 1
            at = at if a else np.append(0, at)
            changes.append(at + a)
            keys.append(least[at])
        none = np.zeros(0, np.int64)
        if not changes:
            return Runs(none.astype(np.uint64), none, none, none)
        change, key = np.concatenate(changes), np.concatenate(keys)
        change, which = np.unique(change, return_index=True)
        key = key[which]
        begin = np.union1d(change, seq.first[:-1][np.diff(seq.first) >= self.length])
        text = np.searchsorted(seq.first, begin, "right") - 1
        last = seq.first[text + 1] - self.length + 1
        end = np.minimum(np.append(begin[1:], len(seq.symbols)), last)
        real = end > begin
        begin, end, text = begin[real], end[real], text[real]
        return Runs(key[np.searchsorted(change, begin, "right") - 1], text, begin, end - begin)


def _sorted_texts(table: pa.Table) -> tuple[pa.Table, np.ndarray]:
    """In an order that a second run of the task repeats."""
    ids = A.numbers(table[ID], 0)
    if len(ids) > 1 and len(np.unique(ids)) < len(ids):
        texts = table[TEXT].to_pylist()
        order = np.array(sorted(range(len(ids)), key=lambda i: (ids[i], texts[i])))
    else:
        order = np.argsort(ids, kind="stable")
    return table.take(pa.array(order)), ids[order]


def _bucket_edges(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket's part of sorted keys begins."""
    bounds = np.array([-(-(b << 64) // buckets) for b in range(1, buckets)], np.uint64)
    return np.concatenate(([0], np.searchsorted(keys, bounds), [len(keys)]))


def _known(windows: Windows, runs: Runs) -> tuple[np.ndarray, np.ndarray]:
    """The minimisers of a block, sorted, and whether a block alone shows each to be repeated."""
    keys, counts = np.unique(runs.keys, return_counts=True)
    if windows.own_text:
        return keys, counts > 1
    order = np.lexsort((runs.text, runs.keys))
    k, t = runs.keys[order], runs.text[order]
    other = np.flatnonzero((k[1:] == k[:-1]) & (t[1:] != t[:-1]))
    return keys, np.isin(keys, k[other])


def _asks(windows: Windows, buckets: int) -> Callable[[pa.Table], pa.Table]:
    def ask(table: pa.Table) -> pa.Table:
        table, _ = _sorted_texts(table)
        keys, multi = _known(windows, windows.runs(windows.read(*A.texts(table[TEXT]))))
        edges = _bucket_edges(keys, buckets)
        full = np.flatnonzero(np.diff(edges))
        block = table[BLOCK][0].as_py()
        rows = [(int(b), block, A.packed(keys[edges[b] : edges[b + 1]]), A.packed(np.packbits(multi[edges[b] : edges[b + 1]]))) for b in full]
        return _table(rows, ["bucket", "block", "keys", "multi"])

    return ask


def _table(rows: list[tuple], names: list[str]) -> pa.Table:
    kinds = {"bucket": pa.int32(), "block": pa.int32(), "kind": pa.int32()}
    columns = list(zip(*rows, strict=True)) or [[]] * len(names)
    return pa.table({n: pa.array(c, kinds.get(n, pa.binary())) for n, c in zip(names, columns, strict=True)})


def _shared(table: pa.Table) -> pa.Table:
    """For each block that asked, which of its minimisers are repeated anywhere."""
    own = [np.frombuffer(x, np.uint64) for x in table["keys"].to_pylist()]
    multi = [np.unpackbits(np.frombuffer(m, np.uint8), count=len(k)) for m, k in zip(table["multi"].to_pylist(), own, strict=True)]
    every = np.concatenate(own)
    order = np.argsort(every, kind="stable")
    ranked = every[order]
    group = np.concatenate(([0], np.cumsum(ranked[1:] != ranked[:-1])))
    often = (np.bincount(group) > 1) | (np.bincount(group, weights=np.concatenate(multi)[order]) > 0)
    bits = np.empty(len(every), np.uint8)
    bits[order] = often[group]
    parts = np.split(bits, np.cumsum([len(k) for k in own])[:-1])
    blocks, bucket = table["block"].to_pylist(), table["bucket"][0].as_py()
    return _table([(b, 0, bucket, A.packed(np.packbits(x))) for b, x in zip(blocks, parts, strict=True)], ["block", "kind", "bucket", "bits"])


@dataclass
class _Strings:
    """The strings a block sends, sorted by minimiser, and which of them each run is."""

    runs: Runs  # only those of repeated minimisers
    string: np.ndarray  # of each run
    lead: np.ndarray  # the first run of each string
    keys: np.ndarray


def _answers(table: pa.Table, kind: int) -> dict[int, bytes]:
    return {b: x for b, k, x in zip(table["bucket"].to_pylist(), table["kind"].to_pylist(), table["bits"].to_pylist(), strict=True) if k == kind}


def _bits(found: dict[int, bytes], edges: np.ndarray) -> np.ndarray:
    """Answers of all buckets, one after the other; edges: how many bits there are up to each bucket."""
    out = np.zeros(edges[-1], bool)
    for b, x in found.items():
        out[edges[b] : edges[b + 1]] = np.unpackbits(np.frombuffer(x, np.uint8), count=edges[b + 1] - edges[b])
    return out


def _strings(windows: Windows, seq: Sequence, answers: pa.Table, buckets: int) -> _Strings:
    runs = windows.runs(seq)
    keys = np.unique(runs.keys)
    often = _bits(_answers(answers, 0), _bucket_edges(keys, buckets))
    kept = often[np.searchsorted(keys, runs.keys)] if len(keys) else np.zeros(0, bool)
    runs = Runs(runs.keys[kept], runs.text[kept], runs.window[kept], runs.count[kept])
    names = A.span_hashes(A.prefix_sums(seq.symbols, seq.values), runs.window, runs.window + runs.count + windows.length - 1)
    order = np.lexsort((np.arange(len(names)), names, runs.keys))
    fresh = np.ones(len(order), bool)
    fresh[1:] = (names[order][1:] != names[order][:-1]) | (runs.keys[order][1:] != runs.keys[order][:-1])
    string = np.empty(len(order), np.int64)
    string[order] = np.cumsum(fresh) - 1
    lead = order[fresh]
    return _Strings(runs, string, lead, runs.keys[lead])


def _sends(windows: Windows, buckets: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def send(table: pa.Table, answers: pa.Table) -> pa.Table:
        names = ["bucket", "block", "data", "ends", "ids", "places"]
        if not table.num_rows:
            return _table([], names)
        table, ids = _sorted_texts(table)
        seq = windows.read(*A.texts(table[TEXT]))
        strings = _strings(windows, seq, answers, buckets)
        lead, runs = strings.lead, strings.runs
        edges = _bucket_edges(strings.keys, buckets)
        begin, end = seq.bytes_of(runs.window[lead], runs.window[lead] + runs.count[lead] + windows.length - 2)
        owner = ids[runs.text[lead]]
        place = runs.window[lead] - seq.first[runs.text[lead]]
        block, rows = table[BLOCK][0].as_py(), []
        for b in np.flatnonzero(np.diff(edges)):
            own = slice(edges[b], edges[b + 1])
            data = A.gather(seq.data, begin[own], end[own])
            rows.append((int(b), block, A.packed(data), A.packed(np.cumsum(end[own] - begin[own])), A.packed(owner[own]), A.packed(place[own])))
        return _table(rows, names)

    return send


def _joined(table: pa.Table, name: str) -> tuple[np.ndarray, np.ndarray]:
    parts = [np.frombuffer(x, np.int64) for x in table[name].to_pylist()]
    return np.concatenate(parts), np.array([len(x) for x in parts])


def _judges(windows: Windows) -> Callable[[pa.Table], pa.Table]:
    def judge(table: pa.Table) -> pa.Table:
        data = np.concatenate([np.frombuffer(x, np.uint8) for x in table["data"].to_pylist()])
        sizes = np.concatenate([np.diff(np.frombuffer(x, np.int64), prepend=0) for x in table["ends"].to_pylist()])
        ids, strings = _joined(table, "ids")
        places, _ = _joined(table, "places")
        bits, windows_of = windows.earlier(data, np.concatenate(([0], np.cumsum(sizes))), ids, places)
        per_row = np.add.reduceat(windows_of, np.cumsum(strings) - strings)
        parts = np.split(bits, np.cumsum(per_row)[:-1])
        bucket = table["bucket"][0].as_py()
        return _table([(b, 1, bucket, A.packed(np.packbits(x))) for b, x in zip(table["block"].to_pylist(), parts, strict=True)], ["block", "kind", "bucket", "bits"])

    return judge


def _finishes(windows: Windows, buckets: int, result: Callable, schema: pa.Schema) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def finish(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return schema.empty_table()
        table, ids = _sorted_texts(table)
        seq = windows.read(*A.texts(table[TEXT]))
        strings = _strings(windows, seq, answers, buckets)
        runs, lead, string = strings.runs, strings.lead, strings.string
        count = runs.count[lead]
        upto = np.concatenate(([0], np.cumsum(count)))
        edges = upto[_bucket_edges(strings.keys, buckets)]
        found = _bits(_answers(answers, 1), edges)
        place = runs.window - seq.first[runs.text]
        first = lead[string]
        again = ids[runs.text] > ids[runs.text[first]]
        if windows.own_text:
            again |= (ids[runs.text] == ids[runs.text[first]]) & (place > place[first])
        hit = found[A.ranges(upto[string], runs.count)] | np.repeat(again, runs.count)
        gone = A.covered(len(seq.symbols), A.ranges(runs.window, runs.count)[hit], windows.length)
        return result(table, seq, gone)

    return finish


def judged(docs: DataFrame, windows: Windows, result: Callable[[pa.Table, Sequence, np.ndarray], pa.Table], schema: str, arrow: pa.Schema, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """result's rows (schema, the same as arrow without _row) for each block, given the symbols that earlier windows cover."""
    size = text_bytes(docs)
    texts = blocked(docs, parts(docs, size, block_bytes))
    buckets = parts(docs, STRETCH * size, block_bytes)
    kind = texts.schema["_row"].dataType.simpleString()
    dealt = texts.groupBy(BLOCK)
    shared = dealt.applyInArrow(_asks(windows, buckets), ASK).groupBy("bucket").applyInArrow(_shared, ANSWER)
    sent = dealt.cogroup(shared.groupBy("block")).applyInArrow(_sends(windows, buckets), SENT)
    earlier = sent.groupBy("bucket").applyInArrow(_judges(windows), ANSWER)
    both = shared.unionByName(earlier)
    return dealt.cogroup(both.groupBy("block")).applyInArrow(_finishes(windows, buckets, result, arrow), f"_row {kind}, {schema}")
