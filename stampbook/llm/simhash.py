"""SimHash near-de-duplication: fingerprints, vantage-point trees over shards, components."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stampbook.llm.components import smallest_labels
from stampbook.llm.working import kept

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
SHARD_POINTS = 8192  # fingerprints of a shard, about
FEWEST_SHARDS = 16
SAMPLE = 8192  # fingerprints from which the upper tree is made
LEAF = 256
PAIRS_AT_ONCE = 1 << 20


def fingerprint(text: bytes, shingle: int = SHINGLE_WORDS) -> int:
    """Bit by bit the majority of the XXH64 of all word shingles, repeats included; 0 without words."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends]
    last = ends[shingle - 1 :] or ends[-1:]
    hashed = xxhash.xxh64_intdigest
    values = np.fromiter((hashed(joined[a : b - 1], SEED) for a, b in zip(starts, last, strict=False)), np.uint64, len(last))
    bits = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return int.from_bytes(np.packbits(2 * bits.sum(0, dtype=np.int64) > len(values), bitorder="little").tobytes(), "little")


def text_hash() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


def fingerprints(docs: DataFrame, shingle: int = SHINGLE_WORDS, hashed: bool = False) -> DataFrame:
    """doc_id and fingerprint (its 64 bits as a long) of each row, and text_hash if hashed."""
    also = ["text_hash"] if hashed else []

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((fingerprint(x.as_py() or b"", shingle) for x in batch["text"]), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_pydict({"doc_id": batch["doc_id"], "fingerprint": found.view(np.int64)} | {c: batch[c] for c in also})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"), *[text_hash().alias(c) for c in also])
    return rows.mapInArrow(each, "doc_id long, fingerprint long" + "".join(f", {c} long" for c in also))


def _distance(points: np.ndarray, one: int) -> np.ndarray:
    return np.bitwise_count(points ^ np.uint64(one))


@dataclass
class Node:
    """A vantage point, and the distance up to which points are on the near side. A leaf has only a shard."""

    vantage: int = 0
    radius: int = 0
    near: Node | None = None
    far: Node | None = None
    shard: int = -1


def _split(points: np.ndarray, tries: int = 4) -> tuple[int, int] | None:
    """The vantage point, of a few, whose median distance has the fewest points close to it."""
    best = None
    for vantage in points[np.linspace(0, len(points) - 1, min(tries, len(points))).astype(int)].tolist():
        distance = _distance(points, vantage)
        radius = int(np.sort(distance)[(len(distance) - 1) // 2])
        if distance.max() > radius:
            close = int(np.count_nonzero(np.abs(distance.astype(np.int64) - radius) <= MAX_BITS))
            if best is None or close < best[0]:
                best = close, vantage, radius
    return best and best[1:]


def _upper_tree(sample: np.ndarray, depth: int) -> tuple[Node, int]:
    shards = 0

    def grow(points: np.ndarray, depth: int) -> Node:
        nonlocal shards
        cut = _split(points) if depth and len(points) > 1 else None
        if cut is None:
            shards += 1
            return Node(shard=shards - 1)
        near = _distance(points, cut[0]) <= cut[1]
        return Node(*cut, grow(points[near], depth - 1), grow(points[~near], depth - 1))

    return grow(sample, depth), shards


def _sides(points: np.ndarray, guests: np.ndarray, node: tuple[int, int], bits: int) -> tuple[np.ndarray, ...]:
    """Masks: points on the near side, near points that may have a partner on the far side, guests for either side.

    For points x and y within ``bits``, the distances to the vantage point differ by ``bits`` at most.
    """
    vantage, radius = node
    at, of = _distance(points, vantage).astype(np.int64), _distance(guests, vantage).astype(np.int64)
    return at <= radius, (at <= radius) & (at + bits > radius), of - bits <= radius, of + bits > radius


def _route(points: np.ndarray, root: Node, bits: int) -> Iterator[tuple[int, np.ndarray, bool]]:
    """Each point goes to one shard, and as a guest to those that its ball reaches. Of two linked points in
    different shards, one is a guest in the other's: that of the near side where their ways part."""
    todo = [(root, points, points[:0])]
    while todo:
        node, own, guests = todo.pop()
        if node.near is None:
            yield node.shard, own, False
            yield node.shard, guests, True
            continue
        near, crossing, to_near, to_far = _sides(own, guests, (node.vantage, node.radius), bits)
        todo.append((node.near, own[near], guests[to_near]))
        todo.append((node.far, own[~near], np.concatenate((guests[to_far], own[crossing]))))


class _Linked:
    """Components of points, by their numbers."""

    def __init__(self, n: int) -> None:
        self.root = np.arange(n)

    def roots(self, i: np.ndarray) -> np.ndarray:
        found = self.root[i]
        while True:
            above = self.root[found]
            if (above == found).all():
                return found
            found = above

    def link(self, i: np.ndarray, j: np.ndarray) -> None:
        while True:
            a, b = self.roots(i), self.roots(j)
            apart = a != b
            if not apart.any():
                return
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            np.minimum.at(self.root, np.maximum(a, b), np.minimum(a, b))


def _search(points: np.ndarray, guests: np.ndarray, bits: int) -> np.ndarray:
    """The component's smallest number for each point and guest (numbered after the points); pairs of guests don't count."""
    every = np.concatenate((points, guests))
    linked = _Linked(len(every))

    def compare(own: np.ndarray, others: np.ndarray) -> None:
        step = max(1, PAIRS_AT_ONCE // max(1, len(others)))
        for a in range(0, len(own), step):
            i, j = np.nonzero(np.bitwise_count(every[own[a : a + step], None] ^ every[None, others]) <= bits)
            if len(i):
                linked.link(own[a : a + step][i], others[j])

    todo = [(np.arange(len(points)), np.arange(len(points), len(every)))]
    while todo:
        own, others = todo.pop()
        cut = _split(every[own]) if len(own) > LEAF else None
        if cut is None:
            for a in range(0, len(own), LEAF):
                compare(own[a : a + LEAF], np.concatenate((own[a:], others)))
            continue
        near, crossing, to_near, to_far = _sides(every[own], every[others], cut, bits)
        todo.append((own[near], others[to_near]))
        todo.append((own[~near], np.concatenate((others[to_far], own[crossing]))))
    return linked.roots(np.arange(len(every)))


def _shard_members(bits: int):
    def members(table: pa.Table) -> pa.Table:
        points = np.asarray(table["item"].combine_chunks()).view(np.uint64)
        guest = np.asarray(table["guest"].combine_chunks().cast(pa.int8())) > 0
        order = np.concatenate((np.sort(points[~guest]), np.sort(points[guest])))
        root = _search(order[: int((~guest).sum())], order[int((~guest).sum()) :], bits)
        several = np.bincount(root, minlength=len(root))[root] > 1
        shard = table["shard"][0].as_py()
        return pa.table({"item": order[several].view(np.int64), "shard": pa.array(np.full(int(several.sum()), shard), pa.int32()), "root": order[root[several]].view(np.int64)})

    return members


def linked_fingerprints(points: DataFrame, bits: int = MAX_BITS, shard_points: int = SHARD_POINTS) -> DataFrame:
    """(item, label): for distinct fingerprints (item) the smallest label reached over links of up to ``bits`` bits.

    points: (item, label). The upper tree comes from a bounded sample; all points go through it. Each shard
    links its points to one another and to its guests, and returns members of components, never pairs.
    """
    n = points.count()
    depth = max(FEWEST_SHARDS, -(-n // shard_points) - 1).bit_length()
    sample = [r[0] for r in points.select("item").orderBy(F.xxhash64("item"), "item").limit(SAMPLE).collect()]
    root, _ = _upper_tree(np.array(sample, np.int64).view(np.uint64), depth)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, own, guest in _route(np.asarray(batch["item"]).view(np.uint64), root, bits):
                if len(own):
                    yield pa.RecordBatch.from_pydict({"shard": pa.array(np.full(len(own), shard), pa.int32()), "item": own.view(np.int64), "guest": np.full(len(own), guest)})

    routed = points.select("item").mapInArrow(route, "shard int, item long, guest boolean")
    found = routed.groupBy("shard").applyInArrow(_shard_members(bits), "item long, shard int, root long")
    members = kept(found.select("item", F.struct("shard", "root").alias("grp")))
    return smallest_labels(members, points)


def near_duplicate_groups(docs: DataFrame, shingle: int = SHINGLE_WORDS, bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id for each row of docs.

    Lower-cased (A-Z) words between white space make shingles; a text with fewer words is one shingle, one
    without words (or null) has fingerprint 0, which links like any other. Fingerprints link at ``bits`` or
    fewer differing bits; component_id is the smallest doc_id reached. A null doc_id is never the smallest
    unless all of a component are null. Repeated rows give repeated rows, an empty table none.
    """
    found = kept(fingerprints(docs, shingle))
    points = kept(found.groupBy(F.col("fingerprint").alias("item")).agg(F.min("doc_id").alias("label")))
    labels = linked_fingerprints(points.select("item", F.coalesce("label", F.lit((1 << 63) - 1)).alias("label")), bits)
    labels = labels.select(F.col("item").alias("fingerprint"), F.expr(f"nullif(label, {(1 << 63) - 1})").alias("component_id"))
    return found.join(labels, "fingerprint").select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


def first_rows(docs: DataFrame, shingle: int = SHINGLE_WORDS, bits: int = MAX_BITS) -> DataFrame:
    """doc_id and text_hash of one row for each component of near_duplicate_groups, by smallest doc_id.

    Components are told by a fingerprint of theirs, so those whose doc_ids are all null, and those that share
    their smallest doc_id, stay apart. A row with a doc_id comes before one without.
    """
    last = F.lit((1 << 63) - 1)
    found = kept(fingerprints(docs, shingle, hashed=True))
    row = F.struct(F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", last).alias("doc_id"), "text_hash")
    points = kept(found.groupBy(F.col("fingerprint").alias("item")).agg(F.min(row).alias("row")))
    labels = linked_fingerprints(points.select("item", F.struct("row", "item").alias("label")), bits)
    first = labels.where("label.item = item").select("label.row.*")
    return first.select(F.when(~F.col("none"), F.col("doc_id")).alias("doc_id"), "text_hash").distinct()


def op2(docs: DataFrame) -> DataFrame:
    return near_duplicate_groups(docs.select("doc_id", "text"))
