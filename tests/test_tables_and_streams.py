"""Files, versioned tables, maintenance and the streaming job."""

import time
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from stampbook.sources import (
    VersionedTable,
    append_rows,
    delete_where,
    incremental_start,
    newest_file,
    read_newest,
    sync_replace,
    upsert,
)
from stampbook.streaming import daily_activity, stream_into


def frame(spark, rows):
    return spark.createDataFrame(rows, "k int, d string, v int")


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_upsert_replaces_inserts_and_keeps(spark):
    target = frame(spark, [(1, "a", 1), (2, "a", 2), (2, "b", 3)])
    source = frame(spark, [(2, "a", 20), (3, "a", 30)]).select("v", "d", "k")
    assert rows(upsert(target, source, ["k", "d"])) == [(1, "a", 1), (2, "a", 20), (2, "b", 3), (3, "a", 30)]
    assert rows(upsert(target.limit(0), source, ["k", "d"])) == [(2, "a", 20), (3, "a", 30)]


def test_upsert_inserts_null_keys(spark):
    target = frame(spark, [(None, "a", 1)])
    assert rows(upsert(target, frame(spark, [(None, "a", 2)]), ["k", "d"])) == [(None, "a", 1), (None, "a", 2)]


def test_sync_delete_append(spark):
    target = frame(spark, [(1, "a", 1), (2, "a", None)])
    assert rows(sync_replace(target, frame(spark, [(9, "z", 9)]))) == [(9, "z", 9)]
    assert rows(delete_where(target, F.col("v") < 5)) == [(2, "a", None)]
    assert append_rows(target, target.drop("d")).count() == 4


def test_add_columns_and_catalog(spark):
    from stampbook.sources import add_columns, catalog_tables

    table = add_columns(frame(spark, [(1, "a", 1)]), {"v": F.lit(9), "w": F.lit("x")})
    assert rows(table) == [(1, "a", 1, "x")]
    table.createOrReplaceTempView("catalog_probe")
    assert catalog_tables(spark, "default")["catalog_probe"]  # listed
    spark.catalog.dropTempView("catalog_probe")


def test_versioned_table_reads_while_rewriting(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    assert not table.exists()
    assert table.write(frame(spark, [(1, "a", 1)])) == 1
    assert table.write(upsert(table.read(), frame(spark, [(1, "a", 5), (2, "b", 2)]), ["k", "d"])) == 2
    assert rows(table.read()) == [(1, "a", 5), (2, "b", 2)]
    assert rows(table.read(1)) == [(1, "a", 1)]
    # a version without its commit marker is not current
    table.write(frame(spark, [(7, "x", 7)]))
    (tmp_path / "t" / "v=3" / "_SUCCESS").rename(tmp_path / "t" / "v=3" / "_UNFINISHED")
    assert table.versions() == [1, 2]
    # the unfinished version is written again
    assert table.write(frame(spark, [(8, "y", 8)])) == 3 and rows(table.read()) == [(8, "y", 8)]


def test_partitioned_versions_are_committed_and_replaced(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "p"))
    assert table.write(frame(spark, [(1, "a", 1), (2, "b", 2)]), ("d",)) == 1
    assert table.exists() and table.write(frame(spark, [(3, "c", 3)]), ("d",)) == 2
    assert rows(table.read().select("k", "d", "v")) == [(3, "c", 3)]
    # what a write left without its commit marker is replaced whole
    (tmp_path / "p" / "v=2" / "_SUCCESS").unlink()
    assert table.write(frame(spark, [(4, "d", 4)]), ("d",)) == 2
    assert rows(table.read().select("k", "d", "v")) == [(4, "d", 4)]


def test_staged_tables_last_for_their_block(spark):
    import os

    from stampbook.sources import shared_folder, staged

    folder = shared_folder(spark).removeprefix("file://")
    with staged(frame(spark, [(1, "a", 1)]), "probe") as table:
        assert rows(table) == [(1, "a", 1)]
        assert "FileScan parquet" in table._jdf.queryExecution().executedPlan().toString()
        assert [x for x in os.listdir(folder) if x.startswith("probe-")]
    assert not [x for x in os.listdir(folder) if x.startswith("probe-")]


def test_newest_file_decides_the_format(spark, tmp_path):
    folder = tmp_path / "drop"
    folder.mkdir()
    (folder / "old.csv").write_text("a,b\n1,2\n")
    time.sleep(1.1)
    (folder / "new.csv").write_text("a,b\n3,4\n")
    assert newest_file(spark, str(folder)).endswith("new.csv")
    assert rows(read_newest(spark, str(folder))) == [("3", "4")]
    time.sleep(1.1)
    (folder / "newest.txt").write_text("x")
    with pytest.raises(ValueError):
        read_newest(spark, str(folder))


def test_archive_load_round_trip(spark, tmp_path):
    source = str(tmp_path / "archive.parquet")
    frame(spark, [(1, "a", 1)]).write.parquet(source)
    table = VersionedTable(spark, str(tmp_path / "archive_table"))
    table.write(spark.read.parquet(source))
    assert rows(table.read()) == [(1, "a", 1)]


def test_incremental_start(spark):
    as_of, start = date(2024, 4, 1), date(2024, 1, 1)
    days = [start + timedelta(days=n) for n in range(100)]
    calendar = spark.createDataFrame([(x,) for x in days], "day_date date")
    loaded = calendar.select(F.col("day_date").alias("full_date"))

    def decide(target):
        return tuple(incremental_start(target, calendar, as_of, start).first())

    assert decide(loaded) == (date(2024, 3, 2), "incremental")
    assert decide(loaded.filter("full_date != date '2024-02-10'")) == (start, "full")
    assert decide(loaded.filter("full_date != date '2024-03-20'")) == (date(2024, 3, 2), "incremental")
    assert decide(loaded.limit(0)) == (start, "full")


def test_stream_equals_batch(spark, tmp_path):
    source, out = str(tmp_path / "in"), VersionedTable(spark, str(tmp_path / "out"))
    schema = "wallet_id long, event_ts timestamp, chnl_nm string, sale_amt_inc_vat long"

    def drop(day_numbers):
        data = [(i, datetime(2024, 1, n, 5 + i), "store" if i % 2 else "ecom", 10 * i) for n in day_numbers for i in range(6)]
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(source)

    for batch in ((1, 2), (2, 3), (4,)):
        drop(batch)
        stream = spark.readStream.schema(schema).parquet(source)
        query = stream_into(daily_activity(stream), out, ("full_date", "chnl_nm"), str(tmp_path / "checkpoint"))
        query.awaitTermination(120)
    expected = daily_activity(spark.read.schema(schema).parquet(source))
    assert rows(out.read().select(*expected.columns)) == rows(expected)
