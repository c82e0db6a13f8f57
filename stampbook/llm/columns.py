"""Column helpers for operators that stay in DataFrame functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLANKS = r"[\x20\x09-\x0D]+"


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """then(value), with value computed once a row wherever then uses it."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def spread(df: DataFrame, row: str, *names: str) -> DataFrame:
    """The fields of the struct row as columns, then the named columns; a field with a name of theirs gives way."""
    fields = [c for c in df.schema[row].dataType.names if c.lower() not in {n.lower() for n in names}]
    return df.select(*[F.col(f"{row}.`{c}`").alias(c) for c in fields], *names)


def words_of(text: Column, separator: str = BLANKS) -> Column:
    return F.array_remove(F.split(text, separator), "")


def lower_ascii(text: Column) -> Column:
    """A-Z to lower case and nothing else; a text of ASCII alone takes the short way."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, upper, lower))


def hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def places(n: Column, window: int) -> Column:
    """0, 1, ... for each window among n things; empty if there is none."""
    return F.when(n >= window, F.sequence(F.lit(0), n - window)).otherwise(F.array().cast("array<int>"))


def grams(symbols: Column, k: int, seed: int = 0) -> Column:
    """A hash of each k consecutive symbols."""
    return F.transform(places(F.size(symbols), k), lambda i: F.xxhash64(F.lit(seed), *[F.get(symbols, i + j) for j in range(k)]))


def smallest(values: Column, width: int) -> Column:
    """The smallest of each so many consecutive values."""
    if width == 1:
        return values
    return F.transform(places(F.size(values), width), lambda i: F.least(*[F.get(values, i + j) for j in range(width)]))


def row_key() -> list[Column]:
    """_id and _hash: rows that agree in them have the same doc_id and text, and so the same result."""
    return [F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("_hash")]


KEY = ["_id", "_hash"]
