"""Dealing documents into blocks of bounded size, which several passes over the same texts share.

A block holds whole documents and is chosen by a hash, so no source, key or group of
copies makes a block large. The exchange that deals the blocks is the same in every
pass, so Spark runs it once and reads it again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_BYTES = 4 << 20
LAST_ID = (1 << 63) - 1  # a missing doc_id comes after all others

BLOCK, ID, TEXT, ROW = "_block", "_id", "_text", "_row"


def text_bytes(docs: DataFrame) -> int:
    return docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0


def parts(docs: DataFrame, size: int, part_bytes: int = BLOCK_BYTES) -> int:
    """So many parts that each has about part_bytes of size; at least one for each shuffle partition."""
    return max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // part_bytes))


def blocked(docs: DataFrame, blocks: int, more: dict[str, Column] | None = None) -> DataFrame:
    """_block int, _id long, _text binary, _row with all other columns and doc_id, and more columns."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    return docs.select(
        F.pmod(F.xxhash64(F.col("doc_id"), F.lit(7)), F.lit(blocks)).cast("int").alias(BLOCK),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias(ID),
        F.coalesce(F.col("text"), F.lit("")).cast("binary").alias(TEXT),
        F.struct(*rest).alias(ROW),
        *[column.alias(name) for name, column in (more or {}).items()],
    )
