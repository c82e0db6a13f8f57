"""Benchmark decontamination by winnowing, in DataFrame functions only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stampbook.llm.columns import KEY, grams, hashes, let, lower_ascii, places, row_key, smallest, spread, words_of

WINDOW_WORDS = 13
GRAM_WORDS = 6
HIT_SHARE = 20  # contaminated if n_hit * HIT_SHARE >= n_words
BROADCAST_ROWS = 200_000  # of 32 bytes at most; beyond it Spark shuffles both sides

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _words(text: Column) -> Column:
    return words_of(lower_ascii(F.coalesce(text, F.lit(""))), SEPARATORS)


def fingerprints(text: Column, window: int, gram: int) -> Column:
    """The smallest gram hash of each window, each once: equal windows have equal ones."""
    return let(_words(text), lambda w: let(hashes(w), lambda h: let(grams(h, gram), lambda g: F.array_distinct(smallest(g, window - gram + 1)))))


def _windows(text: Column, length: int) -> Column:
    """place and two hashes (128 bits) of each window of so many words."""
    return let(
        _words(text),
        lambda w: let(
            hashes(w),
            lambda h: let(
                grams(h, length),
                lambda a: let(
                    F.transform(w, lambda x: F.xxhash64(F.lit(1), x)),
                    lambda h2: let(grams(h2, length, 2), lambda b: F.transform(places(F.size(w), length), lambda i: F.struct(i.alias("start"), F.get(a, i).alias("one"), F.get(b, i).alias("two")))),
                ),
            ),
        ),
    )


def _bounded(small: DataFrame) -> DataFrame:
    """small, to be broadcast if it has few enough rows."""
    return F.broadcast(small) if small.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else small


def _item_windows(benchmark: DataFrame, length: int, whole: bool) -> DataFrame:
    """item, one, two: the windows of items with so many words (whole), or with at least so many."""
    size = F.size(_words(F.col("text")))
    items = benchmark.where(size == length if whole else size >= length)
    return items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.explode(_windows(F.col("text"), length)).alias("w")).select("item", "w.one", "w.two").distinct()


def _hits(rows: DataFrame, items: DataFrame, length: int) -> DataFrame:
    """_id, _hash, start, length and the window's hashes for each window of rows that items has."""
    found = rows.select(*KEY, F.explode(_windows(F.col("text"), length)).alias("w")).select(*KEY, "w.*")
    return found.join(_bounded(items.select("one", "two").distinct()), ["one", "two"]).select(*KEY, "start", F.lit(length).alias("length"), "one", "two")


def benchmark_overlap(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW_WORDS, gram: int = GRAM_WORDS, with_text: bool = False) -> DataFrame:
    """All columns of docs but text (unless with_text), and n_words, n_hit, items (sorted ids as strings), contaminated.

    Words are lower-cased (A-Z) runs of digits, letters and characters beyond ASCII. A window is ``window``
    words; an item with fewer, but some, is one window. Documents whose winnowed fingerprints meet the
    benchmark's are taken to all windows, which are compared whole; every shared span of a window is found,
    since its smallest gram hash is the same on both sides. A word inside any shared window is hit.
    Nulls and empty texts have no words and are clean. A null item_id counts as the empty string. Repeated
    rows give repeated rows; an empty benchmark hits nothing; extra columns pass through.
    """
    if not 0 < gram <= window:
        raise ValueError("a gram has at least one word and at most a window's")
    rows = docs.select(*row_key(), F.col("text"))
    short = [r[0] for r in benchmark.select(F.size(_words(F.col("text"))).alias("n")).where(f"n > 0 and n < {window}").distinct().collect()]
    bench_prints = benchmark.select(F.explode(fingerprints(F.col("text"), window, gram)).alias("print")).distinct()
    prints = rows.select(*KEY, F.explode(fingerprints(F.col("text"), window, gram)).alias("print"))
    candidates = prints.join(_bounded(bench_prints), "print").select(*KEY).distinct()
    long_items = _item_windows(benchmark, window, False)
    hits = [_hits(rows.join(candidates, KEY, "left_semi"), long_items, window)]
    items = [long_items]
    for n in short:  # at most window - 1 lengths
        of_length = _item_windows(benchmark, n, True)
        items.append(of_length)
        hits.append(_hits(rows, of_length, n))
    every = reduce(DataFrame.unionByName, hits).distinct()
    by_start = Window.partitionBy(*KEY).orderBy("start", "length")
    before = F.coalesce(F.max(F.col("start") + F.col("length")).over(by_start.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    end = F.col("start") + F.col("length")
    new = every.select(*KEY, F.greatest(F.lit(0), end - F.greatest(F.col("start"), before)).alias("n"))
    n_hit = new.groupBy(*KEY).agg(F.sum("n").alias("n_hit"))
    of_items = every.select(*KEY, "one", "two").distinct().join(_bounded(reduce(DataFrame.unionByName, items)), ["one", "two"])
    named = of_items.select(*KEY, "item").distinct().groupBy(*KEY).agg(F.array_sort(F.collect_list("item")).alias("items"))
    found = n_hit.join(named, KEY)
    base = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if with_text or c != "text"]).alias("_row"), *row_key(), F.size(_words(F.col("text"))).cast("long").alias("n_words"))
    joined = base.join(found, KEY, "left").withColumn("n_hit", F.coalesce("n_hit", F.lit(0)).cast("long"))
    joined = joined.withColumn("items", F.coalesce("items", F.array().cast("array<string>")))
    judged = joined.withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * HIT_SHARE >= F.col("n_words")))
    return spread(judged, "_row", "n_words", "n_hit", "items", "contaminated")


def op6(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    found = benchmark_overlap(docs.select("doc_id", "text"), benchmark)
    digest = F.sha2(F.array_join("items", ",").cast("binary"), 256)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), digest.alias("items_sha256"), "contaminated")
