"""Writes that die at any of their file operations, and what readers and the next writer then see."""

import datetime as dt
import os

import pytest

from ledgerlens.operators.incremental import merge_upsert, prepare_upsert
from ledgerlens.sources import commits
from ledgerlens.sources.commits import Commit, Files, read_table, recover
from ledgerlens.sources.sinks import write_table

T0 = dt.datetime(2024, 1, 1)
DAY = dt.timedelta(1)
JAN, FEB, MAR = (dt.date(2024, m, 1) for m in (1, 2, 3))


class Died(Exception):
    pass


def dies_after(monkeypatch, calls):
    """Let the file system fail for good after so many moves, deletions and writes."""
    left = [calls]
    for name in ("move", "delete", "write"):
        real = getattr(Files, name)

        def call(self, *args, real=real):
            if left[0] == 0:
                raise Died
            left[0] -= 1
            return real(self, *args)
        monkeypatch.setattr(Files, name, call)


def frame(spark, rows):
    return spark.createDataFrame(rows, "k string, m date, v int, ts timestamp_ntz")


def rows_of(df):
    return sorted((r["k"], str(r["m"]), r["v"]) for r in df.collect())


OLD = [("a", JAN, 1, T0), ("b", FEB, 2, T0), ("n", None, 3, T0), ("x", MAR, 4, T0)]
BATCH = [("b", JAN, 20, T0 + DAY), ("n", FEB, 30, T0 + DAY), ("c", None, 5, T0), ("a", JAN, 0, T0 - DAY)]
AFTER = [("a", "2024-01-01", 1), ("b", "2024-01-01", 20), ("c", "None", 5), ("n", "2024-02-01", 30), ("x", "2024-03-01", 4)]
BEFORE = sorted((k, str(m), v) for k, m, v, _ in OLD)


@pytest.mark.parametrize("partitioned", [True, False])
def test_upsert_that_dies_anywhere_is_whole_after_the_next(spark, tmp_dir, monkeypatch, partitioned):
    """b leaves February, n leaves the null partition; every point of death leads to the same table."""
    part, calls, seen = "m" if partitioned else None, 0, set()
    while True:
        path = f"{tmp_dir}/t{calls}"
        merge_upsert(spark, path, frame(spark, OLD), "k", "ts", part)
        with monkeypatch.context() as m:
            dies_after(m, calls)
            try:
                merge_upsert(spark, path, frame(spark, BATCH), "k", "ts", part)
                died = False
            except Died:
                died = True
        now = rows_of(read_table(spark, path))
        assert now in (BEFORE, AFTER)
        seen.add(now == AFTER)
        merge_upsert(spark, path, frame(spark, BATCH), "k", "ts", part)
        assert rows_of(spark.read.parquet(path)) == AFTER
        assert not os.listdir(commits.staging_root(path))
        if not died:
            break
        calls += 1
    assert calls >= 4 and seen == {True, False}


def test_committed_write_is_read_before_it_is_moved(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    merge_upsert(spark, path, frame(spark, OLD), "k", "ts", "m")
    write, summary = prepare_upsert(spark, path, frame(spark, BATCH), "k", "ts", "m")
    assert rows_of(read_table(spark, path)) == BEFORE and summary["inserted_or_updated"] == 3
    write.commit()
    assert rows_of(read_table(spark, path)) == AFTER
    assert rows_of(spark.read.parquet(path)) == BEFORE
    assert recover(spark, path) == 1 and recover(spark, path) == 0
    assert rows_of(spark.read.parquet(path)) == AFTER


def test_table_with_a_key_twice_heals(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    merge_upsert(spark, path, frame(spark, OLD), "k", "ts", "m")
    frame(spark, [("a", FEB, 7, T0)]).write.mode("append").partitionBy("m").parquet(path)
    merge_upsert(spark, path, frame(spark, [("a", MAR, 8, T0 + DAY)]), "k", "ts", "m")
    assert [r for r in rows_of(spark.read.parquet(path)) if r[0] == "a"] == [("a", "2024-03-01", 8)]


def test_rebuild_that_dies_anywhere(spark, tmp_dir, monkeypatch):
    path, calls = f"{tmp_dir}/t", 0
    new = frame(spark, [("z", JAN, 9, T0)])
    while True:
        write_table(frame(spark, OLD), path)
        with monkeypatch.context() as m:
            dies_after(m, calls)
            try:
                write_table(new, path)
                break
            except Died:
                calls += 1
        assert rows_of(read_table(spark, path)) in (BEFORE, [("z", "2024-01-01", 9)])
    assert calls >= 3 and rows_of(spark.read.parquet(path)) == [("z", "2024-01-01", 9)]


def test_rebuild_from_the_table_itself(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    write_table(frame(spark, OLD), path)
    write_table(spark.read.parquet(path).where("v > 2"), path)
    assert [r[0] for r in rows_of(spark.read.parquet(path))] == ["n", "x"]


def test_one_commit_of_several_tables(spark, tmp_dir, monkeypatch):
    """Rows and their ledger appear together, whichever move fails, and only once."""
    calls = 0
    while True:
        rows, ledger = f"{tmp_dir}/rows{calls}", f"{tmp_dir}/ledger{calls}"
        with monkeypatch.context() as m:
            dies_after(m, calls)
            try:
                write = Commit(spark, ledger)
                write.append(frame(spark, OLD), rows, ["m"])
                write.append(spark.createDataFrame([("f1",)], "file string"), ledger)
                write.finish()
                died = False
            except Died:
                died = True
        finished = recover(spark, ledger)
        loaded = read_table(spark, ledger)
        assert (loaded is None) == (read_table(spark, rows) is None)
        if loaded is not None:
            assert loaded.count() == 1 and rows_of(spark.read.parquet(rows)) == BEFORE
        if not died:
            assert not finished
            break
        calls += 1
    assert calls >= 4


def test_missing_table(spark, tmp_dir):
    assert read_table(spark, f"{tmp_dir}/none") is None and recover(spark, f"{tmp_dir}/none") == 0


def test_partition_names(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    rows = spark.createDataFrame([("a", "x/y=z", 1, T0), ("b", "001", 2, T0), ("c", "ü %", 3, T0)], "k string, p string, v int, ts timestamp_ntz")
    merge_upsert(spark, path, rows, "k", "ts", "p")
    moved = spark.createDataFrame([(k, "001", 9, T0 + DAY) for k in "abc"], rows.schema)
    merge_upsert(spark, path, moved, "k", "ts", "p")
    assert [n for n in os.listdir(path) if "=" in n] == ["p=001"] and spark.read.parquet(path).count() == 3
