"""Phrase collocations: frequent phrases counted by broadcast double-array tries, scored against their parts."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stampbook.llm.working import kept

LEAST, LONGEST, TOP = 100, 5, 2000
UNKNOWN = "und"
MOST_WORDS, MOST_WORD_BYTES = 500_000, 16 << 20  # of one broadcast vocabulary; more words make more of them
MOST_PHRASES = 1_000_000  # of one broadcast trie (about 100 MB); more phrases make more tries
CHUNK_BYTES = 2 << 20
COUNT_BYTES = 64 << 20  # of word numbers that one task counts: each task hands out a sum for every phrase it meets

_BREAKS = b".,;:!?\n\x0b\x0c\r"
_PLAIN = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ" + _BREAKS + b"\t", b"abcdefghijklmnopqrstuvwxyz" + b"," * len(_BREAKS) + b" ")


class DoubleArray:
    """A trie of phrases over word numbers, as arrays that all positions of a text walk at once.

    A word is two symbols: its rank in ``alphabet`` divided by ``radix``, and the rest, so no state has more than
    ``radix`` children. The child of state s by symbol x is the state t = base[s] + x, and is there if check[t] is s.
    State 0 is dead, the last one is the root. ``row`` is the number of the state's phrase in ``phrases`` (one row
    each, ending in zeros), counted from 1; 0 for states within a word, and after one word.
    """

    def __init__(self, phrases: np.ndarray):
        """phrases: different rows, and with each all its beginnings of two words and more."""
        length = (phrases > 0).sum(axis=1)
        self.phrases, self.alphabet = phrases, np.unique(phrases[phrases > 0])
        self.radix = max(2, int(np.ceil(np.sqrt(len(self.alphabet)))))
        parents, symbols, children = [], [], []
        nodes, of_row = 1, np.zeros(len(phrases), np.int64)  # node 0 is the root; the node of each phrase so far
        rank = np.searchsorted(self.alphabet, phrases)
        last = np.zeros(len(phrases), np.int64)
        for k in range(phrases.shape[1]):
            alive = np.flatnonzero(length > k)
            for symbol in (rank[:, k] // self.radix, rank[:, k] % self.radix):
                keys, first, back = np.unique(of_row[alive] * self.radix + symbol[alive], return_index=True, return_inverse=True)
                parents.append(of_row[alive][first])
                symbols.append(symbol[alive][first])
                children.append(nodes + np.arange(len(keys)))
                of_row[alive] = nodes + back
                nodes += len(keys)
            last[alive[length[alive] == k + 1]] = of_row[alive[length[alive] == k + 1]]
        parent, symbol, child = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (parents, symbols, children))
        order = np.lexsort((symbol, parent))
        parent, symbol, child = parent[order], symbol[order], child[order]
        starts = np.flatnonzero(np.diff(parent, prepend=-1))
        base, size = _placed(symbol, starts, self.radix)
        root = size + 1
        state = np.zeros(nodes, np.int64)
        edge_base = np.repeat(base, np.diff(np.append(starts, len(parent))))
        state[child] = edge_base + symbol
        state[0] = root
        self.base, self.check = np.zeros(root + 1, np.int32), np.full(root + self.radix + 1, -1, np.int32)
        self.base[state[parent]] = edge_base
        self.check[state[child]] = state[parent]
        self.row = np.zeros(root + 1, np.int32)
        many = length > 1
        self.row[state[last[many]]] = np.flatnonzero(many) + 1

    def arrays(self) -> dict:
        """What a task needs to walk the trie, as plain arrays."""
        return dict(self.__dict__)

    @classmethod
    def of(cls, arrays: dict) -> DoubleArray:
        trie = cls.__new__(cls)
        trie.__dict__ |= arrays
        return trie

    def _step(self, states: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        following = self.base[states] + symbols
        following[self.check[following] != states] = 0
        return following

    def levels(self, words: np.ndarray, depth: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For 1, 2, ... words: the positions where phrases go on, and the states that are reached there."""
        if not len(self.alphabet):
            return
        rank = np.minimum(np.searchsorted(self.alphabet, words), len(self.alphabet) - 1).astype(np.int32)
        known = self.alphabet[rank] == words
        high, low = np.where(known, rank // self.radix, self.radix), np.where(known, rank % self.radix, self.radix)
        at = np.arange(len(words))
        states = np.full(len(words), len(self.base) - 1, np.int32)
        for k in range(depth):
            if k:
                inside = at < len(words) - k
                at, states = at[inside], states[inside]
            states = self._step(self._step(states, high[at + k]), low[at + k])
            alive = np.flatnonzero(states)
            at, states = at[alive], states[alive]
            yield at, states


def _placed(symbols: np.ndarray, starts: np.ndarray, radix: int, rounds: int = 24, large: int = 8) -> tuple[np.ndarray, int]:
    """A base for each group of symbols (groups begin at ``starts``), so that no two share a slot; and the last slot.

    Groups of more than ``large`` symbols get a span of their own. The others look for gaps: all still without a
    place try a base at random at once, and those that meet no other take it; what is left gets a span at the end.
    Groups of one symbol fill single gaps.
    """
    sizes = np.diff(np.append(starts, len(symbols)))
    if not len(sizes):
        return np.zeros(0, np.int64), 0
    least, most = np.minimum.reduceat(symbols, starts), np.maximum.reduceat(symbols, starts)
    base = np.zeros(len(sizes), np.int64)
    group = np.repeat(np.arange(len(sizes)), sizes)
    random = np.random.default_rng(0)
    end = 1

    def spans(groups: np.ndarray) -> None:
        nonlocal end
        widths = most[groups] - least[groups] + 1
        base[groups] = end + np.cumsum(widths) - widths - least[groups]
        end += int(widths.sum())

    spans(np.flatnonzero(sizes > large))
    few = np.flatnonzero((sizes > 1) & (sizes <= large))
    room = end + int(2 * len(symbols)) + radix + 1
    taken = np.zeros(room + radix, bool)
    placed = sizes > large
    taken[(base[group] + symbols)[placed[group]]] = True
    for _ in range(rounds):
        if not len(few):
            break
        base[few] = random.integers(1, room, len(few)) - least[few]
        edge = np.flatnonzero(np.isin(group, few)) if len(few) < len(sizes) else np.arange(len(group))
        edge = edge[base[group[edge]] + symbols[edge] < len(taken)]
        slots = base[group[edge]] + symbols[edge]
        claim = np.full(len(taken), -1, np.int64)
        claim[slots] = group[edge]
        lost = np.zeros(len(sizes), bool)
        lost[group[edge[taken[slots] | (claim[slots] != group[edge])]]] = True
        lost[few[base[few] + most[few] >= len(taken)]] = True
        won = few[~lost[few]]
        placed[won] = True
        mine = edge[placed[group[edge]] & ~lost[group[edge]]]
        taken[base[group[mine]] + symbols[mine]] = True
        few = few[lost[few]]
    end = int(np.flatnonzero(taken)[-1]) + 1 if taken.any() else 1
    spans(few)
    taken = np.concatenate([taken[:end], np.zeros(max(0, end - len(taken)), bool)])
    taken[(base[group] + symbols)[np.isin(group, few)]] = True
    one = np.flatnonzero(sizes == 1)
    gaps = np.flatnonzero(~taken[1:]) + 1
    gaps = np.concatenate([gaps, end + np.arange(max(0, len(one) - len(gaps)))])[: len(one)]
    base[one] = gaps - least[one]
    return base, max(end - 1, int(gaps.max(initial=0)))


class Tally:
    """Counts by 64-bit keys of bounded number; what goes beyond is handed out early."""

    def __init__(self, most: int = 2_000_000):
        self.most, self.keys, self.counts, self.held = most, [], [], 0

    def add(self, keys: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        keys, counts = np.unique(keys, return_counts=True)
        self.keys.append(keys)
        self.counts.append(counts)
        self.held += len(keys)
        if self.held > self.most:
            merged = self._merged()
            if len(merged[0]) > self.most // 2:
                yield merged
                merged = (np.zeros(0, np.int64), np.zeros(0, np.int64))
            self.keys, self.counts, self.held = [merged[0]], [merged[1]], len(merged[0])

    def rest(self) -> tuple[np.ndarray, np.ndarray]:
        return self._merged()

    def _merged(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.keys:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        keys, back = np.unique(np.concatenate(self.keys), return_inverse=True)
        counts = np.zeros(len(keys), np.int64)
        np.add.at(counts, back, np.concatenate(self.counts))
        return keys, counts


def _words(plain: bytes) -> list[bytes]:
    """Words, and b',' between pieces, of a text in plain form."""
    return plain.replace(b",", b" , ").split()


def _cuts(plain: bytes) -> Iterator[bytes]:
    """Parts of a long text between pieces, of CHUNK_BYTES or the length of one piece."""
    a = 0
    while len(plain) - a > CHUNK_BYTES:
        b = plain.rfind(b",", a + 1, a + CHUNK_BYTES)
        b = b if b > 0 else plain.find(b",", a + CHUNK_BYTES)
        if b < 0:
            break
        yield plain[a:b]
        a = b
    yield plain[a:]


def _chunks(batch: pa.RecordBatch) -> Iterator[tuple[str, bytes]]:
    """(lang, texts of it in plain form, as pieces) of about CHUNK_BYTES each."""
    held: dict[str, list[bytes]] = {}
    sizes: Counter[str] = Counter()
    for lang, text in zip(batch["lang"], batch["text"], strict=True):
        lang = lang.as_py()
        for part in _cuts(text.as_py().translate(_PLAIN)):
            held.setdefault(lang, []).append(part)
            sizes[lang] += len(part)
            if sizes[lang] >= CHUNK_BYTES:
                yield lang, b",".join(held.pop(lang))
                del sizes[lang]
    for lang, parts in held.items():
        yield lang, b",".join(parts)


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, Counter] = {}

    def out() -> pa.RecordBatch:
        rows = [(lang, word, n) for lang, of in counts.items() for word, n in of.items() if word != b","]
        langs, words, ns = zip(*rows, strict=True) if rows else ((), (), ())
        return pa.RecordBatch.from_pydict({"lang": pa.array(langs, pa.string()), "word": pa.array(words, pa.binary()), "n": pa.array(ns, pa.int64())})

    for batch in batches:
        for lang, plain in _chunks(batch):
            counts.setdefault(lang, Counter()).update(_words(plain))
            if sum(map(len, counts.values())) > 500_000:
                yield out()
                counts.clear()
    yield out()


def _numbered(vocabulary, whole: bool):
    """Numbers of the words of texts, 0 for other words and between pieces; a row with numbers has more of them filled in."""

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = vocabulary.value
        for batch in batches:
            found = "ids" in batch.schema.names
            chunks = zip(batch["lang"].to_pylist(), batch["text"].to_pylist(), strict=True) if found else _chunks(batch)
            for k, (lang, plain) in enumerate(chunks):
                words = _words(plain)
                of = numbers.get(lang, {})
                ids = np.fromiter((of.get(w, 0) for w in words), np.int32, len(words))
                if found:
                    ids = ids + np.frombuffer(batch["ids"][k].as_py(), np.int32)
                row = {"ids": pa.array([ids.tobytes()], pa.binary())}
                if not whole:
                    row |= {"lang": [lang], "text": pa.array([plain], pa.binary())}
                yield pa.RecordBatch.from_pydict(row)

    return numbered


def _extended(trie, k: int, alone: bool):
    """(state of k - 1 words, next word) pairs and how often each occurs; for k = 2 the state is the first word.

    Only phrases whose first k - 1 words, and last k - 1 if this is the only trie, are frequent: all others
    occur less often than the least frequent of their parts.
    """

    def extended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = Tally()
        tree = DoubleArray.of(trie.value) if trie is not None else None

        def out(keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"key": keys, "n": counts})

        for batch in batches:
            for value in batch["ids"]:
                words = np.frombuffer(value.as_buffer(), np.int32)
                at, states = np.flatnonzero(words), words[words > 0]
                if tree is not None:
                    at, states = at[:0], states[:0]
                    for at, states in tree.levels(words, k - 1):  # noqa: B007 - the last ones stay
                        pass
                inside = at < len(words) - k + 1
                inside[inside] = words[at[inside] + k - 1] > 0
                if tree is not None and alone:
                    reached = np.zeros(len(words) + 1, bool)
                    reached[at] = True
                    inside &= reached[at + 1]
                at, states = at[inside], states[inside].astype(np.int64)
                for full in tally.add((states << 32) | words[at + k - 1]):
                    yield out(*full)
        yield out(*tally.rest())

    return extended


def _spelt(trie, k: int):
    """The words of the pairs of _extended."""

    def spelt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.asarray(batch["key"])
            before = keys >> 32
            rows = np.zeros((len(keys), k), np.int32)
            rows[:, : k - 1] = trie.value["phrases"][trie.value["row"][before] - 1][:, : k - 1] if trie is not None else before[:, None]
            rows[:, k - 1] = keys & 0xFFFFFFFF
            yield pa.RecordBatch.from_pydict({"words": _lists(rows)})

    return spelt


def _lists(rows: np.ndarray) -> pa.Array:
    length = (rows > 0).sum(axis=1)
    return pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(length)]).astype(np.int32), pa.array(rows[rows > 0].astype(np.int32)))


def _counted(trie, longest: int):
    """How often each state of two words and more is reached, summed over the texts of the task."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = DoubleArray.of(trie.value)
        total = np.zeros(len(tree.base), np.int64)
        for batch in batches:
            for value in batch["ids"]:
                for k, (_, states) in enumerate(tree.levels(np.frombuffer(value.as_buffer(), np.int32), longest)):
                    if k:
                        total += np.bincount(states, minlength=len(total))
        reached = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"key": reached, "n": total[reached]})

    return counted


def _named(trie):
    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"words": _lists(trie.value["phrases"][trie.value["row"][np.asarray(batch["key"])] - 1]), "a": batch["n"]})

    return named


def _tries(spark: SparkSession, phrases: DataFrame, width: int, most: int) -> Iterator[tuple[object, bool]]:
    """Broadcast tries of the phrases, and whether there is only one; dealt by the first two words, one after another."""
    many = phrases.count()
    parts = max(1, -(-many // most))
    for part in range(parts if many else 0):
        of = phrases if parts == 1 else phrases.where(F.pmod(F.xxhash64(F.slice("words", 1, 2)), F.lit(parts)) == part)
        lists = of.select("words").toArrow()["words"].combine_chunks()
        rows = np.zeros((len(lists), width), np.int32)
        length = np.asarray(lists.value_lengths())
        rows[np.arange(width) < length[:, None]] = np.asarray(lists.flatten())
        trie = spark.sparkContext.broadcast(DoubleArray(rows).arrays())
        yield trie, parts == 1


def _vocabulary(texts: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """lang, word, n, id of the frequent words (ids 1, 2, ...), and n of each lang over all words."""
    counts = kept(texts.mapInArrow(_word_counts, "lang string, word binary, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")))
    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = counts.where(F.col("n") >= least).withColumn("_part", F.pmod(F.xxhash64("lang", "word"), F.lit(parts)).cast("int"))
    sizes = {r["_part"]: r["n"] for r in dealt.groupBy("_part").agg(F.count("*").alias("n")).collect()}
    before = np.concatenate([[0], np.cumsum([sizes.get(p, 0) for p in range(parts)])]).tolist()
    place = F.row_number().over(Window.partitionBy("_part").orderBy("lang", "word"))
    number = (place + F.get(F.lit(before[:-1]), F.col("_part"))).cast("int")
    return kept(dealt.withColumn("id", number).select("lang", "word", "n", "id")), counts.groupBy("lang").agg(F.sum("n").alias("n"))


def _encoded(texts: DataFrame, words: DataFrame, most: int) -> DataFrame:
    """ids: the numbers of the words of chunks of texts, as bytes of 32-bit integers."""
    size = words.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("word") + 40), F.lit(0)).alias("bytes")).first()
    shards = max(1, -(-size["n"] // most), -(-size["bytes"] // (MOST_WORD_BYTES + 40 * most)))
    step = -(-size["n"] // shards) or 1
    frame = texts
    for shard in range(shards):
        rows = words.where(F.col("id").between(shard * step + 1, (shard + 1) * step)).select("lang", "word", "id").toArrow().to_pydict()
        numbers: dict[str, dict[bytes, int]] = {}
        for lang, word, number in zip(rows["lang"], rows["word"], rows["id"], strict=True):
            numbers.setdefault(lang, {})[bytes(word)] = number
        whole = shard == shards - 1
        frame = kept(frame.mapInArrow(_numbered(texts.sparkSession.sparkContext.broadcast(numbers), whole), "ids binary" if whole else "ids binary, lang string, text binary"))
    return frame


def frequent_phrases(encoded: DataFrame, least: int, longest: int, most: int) -> DataFrame:
    """words (ids), a of all phrases of two to ``longest`` frequent words found at least ``least`` times.

    Level by level, the texts propose the phrases that extend a frequent one and have enough places; all
    proposed phrases are then counted by tries: every position's state is advanced at once, one word a level,
    states are counted by their numbers and the counts summed over all tasks.
    """
    spark = encoded.sparkSession
    none = spark.createDataFrame([], "words array<int>")
    levels = []
    before = None
    for k in range(2, longest + 1):
        found = []
        for trie, alone in [(None, True)] if k == 2 else _tries(spark, before, k - 1, most):
            pairs = encoded.mapInArrow(_extended(trie, k, alone), "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
            found.append(kept(pairs.select("key").mapInArrow(_spelt(trie, k), "words array<int>")))
        levels += found
        # the trie of the next level needs all beginnings of its phrases
        before = none
        for level in levels:
            before = before.unionByName(level)
        if not found or not any(f.limit(1).count() for f in found):
            break
    counted = none.withColumn("a", F.lit(0).cast("long"))
    size = encoded.agg(F.sum(F.octet_length("ids")).alias("bytes")).first()["bytes"] or 0
    shards = encoded.coalesce(max(1, -(-size // COUNT_BYTES)))
    for trie, _ in _tries(spark, before, longest, most):
        sums = shards.mapInArrow(_counted(trie, longest), "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
        counted = counted.unionByName(kept(sums.mapInArrow(_named(trie), "words array<int>, a long")))
    return counted


def _score(a: Column, n: Column, left: Column, right: Column) -> Column:
    """floor(1000 a n / (left right)), exact."""
    above = F.lit(1000).cast("decimal(4,0)") * (a.cast("decimal(16,0)") * n.cast("decimal(17,0)"))
    below = left.cast("decimal(18,0)") * right.cast("decimal(18,0)")
    return F.call_function("div", above.cast("decimal(38,0)"), below.cast("decimal(38,0)"))


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, most_words: int = MOST_WORDS, most_phrases: int = MOST_PHRASES) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` phrases of each language by score, then a, then phrase.

    Texts are lower-cased (A-Z), split at . , ; : ! ? and line ends into pieces, and these at spaces and tabs into
    words. a counts the places of a phrase of two to ``longest`` words within pieces, overlaps too, n all words of
    the language, l and r the places of the two parts of the cut that scores lowest (of equal ones the earliest).
    Phrases with a below ``least`` don't count; those inside a longer one that is found as often are dropped.
    A null lang counts as ``und``; null and empty texts have no words; rows without a doc_id and repeated rows count
    like any other; an empty table gives no rows; other columns are not used. Numbers are exact while l, r and a have
    at most 16 digits and n 17.
    """
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))
    words, totals = _vocabulary(texts, least)
    phrases = frequent_phrases(_encoded(texts, words, most_words), least, longest, most_phrases)

    parts = phrases.select(F.col("words").alias("part"), F.col("a").alias("f")).unionByName(words.select(F.array("id").alias("part"), F.col("n").alias("f")))
    size = F.size("words")
    longer = phrases.where(size > 2).select(F.explode(F.array(F.slice("words", F.lit(1), size - 1), F.slice("words", F.lit(2), size - 1))).alias("words"), F.col("a").alias("longer"))
    most = longer.groupBy("words").agg(F.max("longer").alias("longer"))
    free = phrases.join(most, "words", "left").where("longer is null or longer < a").select("words", "a")
    spelt = free.select("words", "a", F.posexplode("words").alias("at", "id")).join(words.select("id", "lang", "word"), "id")
    named = spelt.groupBy("words", "a", "lang").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", F.col("word").cast("string").alias("w")))), lambda x: x["w"]), " ").alias("phrase"))
    cut = named.join(totals, "lang").select("*", F.explode(F.sequence(F.lit(1), size - 1)).alias("cut"))
    left = parts.select(F.col("part").alias("_left"), F.col("f").alias("l"))
    right = parts.select(F.col("part").alias("_right"), F.col("f").alias("r"))
    cut = cut.withColumn("_left", F.slice("words", F.lit(1), F.col("cut"))).withColumn("_right", F.slice("words", F.col("cut") + 1, size - F.col("cut")))
    scored = cut.join(left, "_left").join(right, "_right").withColumn("score", _score(F.col("a"), F.col("n"), F.col("l"), F.col("r")))
    lowest = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "cut", "l", "r")).alias("_s"))
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = lowest.select("lang", "phrase", "a", "_s.l", "_s.r", "n", "_s.score").withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op12(docs: DataFrame) -> DataFrame:
    return collocations(docs.select("lang", "text"))
