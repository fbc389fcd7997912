"""Versioned tables: readers during a publish, publishers that die at each step, conflicts, expiry."""

import glob
import os

import pytest

from strata.sources import tables as T


def rows(df):
    return sorted(r[0] for r in df.collect())


def test_a_reader_keeps_its_version_while_others_are_published(spark, tmp_uri):
    t = f"{tmp_uri}/t"
    T.publish(spark.range(5), t)
    before = T.read_table(spark, t)
    staged = T.stage(spark.range(9), t)
    assert rows(T.read_table(spark, t)) == list(range(5))     # staged is not published
    T.switch(spark, staged, t)
    assert rows(before) == list(range(5)) and rows(T.read_table(spark, t)) == list(range(9))
    assert rows(T.read_table(spark, t, 1)) == list(range(5))
    assert [v.number for v in T.history(spark, t)] == [1, 2]


def test_a_publisher_that_dies_leaves_the_old_version(spark, tmp_uri, monkeypatch):
    t = f"{tmp_uri}/t"
    T.publish(spark.range(5), t)
    with pytest.raises(Exception):                             # while writing
        T.publish(spark.range(5).selectExpr("assert_true(id < 3) as a", "id"), t)
    assert rows(T.read_table(spark, t)) == list(range(5))
    staged = T.stage(spark.range(7), t)                        # written, never committed
    assert rows(T.read_table(spark, t)) == list(range(5))
    open(f"{t}/_pointers/0000000002.json", "w").close()        # pointer created, not filled
    assert rows(T.read_table(spark, t)) == list(range(5))
    with open(f"{t}/_pointers/0000000003.json", "w") as f:     # or half filled
        f.write('{"version": 3, "par')
    assert rows(T.read_table(spark, t)) == list(range(5))
    T.switch(spark, staged, t)                                 # the next publisher goes on behind them
    assert rows(T.read_table(spark, t)) == list(range(7)) and T.current(spark, t).number == 4


def test_incomplete_folders_are_not_published(spark, tmp_uri):
    t = f"{tmp_uri}/t"
    staged = T.stage(spark.range(3), t)
    os.remove(f"{staged}/_SUCCESS")
    with pytest.raises(OSError):
        T.switch(spark, staged, t)
    assert T.current(spark, t) is None
    T.discard(spark, staged)
    assert not os.path.exists(t)


def test_two_publishers_cannot_take_one_number(spark, tmp_uri, monkeypatch):
    t = f"{tmp_uri}/t"
    T.publish(spark.range(1), t)
    numbers = T._numbers
    seen = []

    def late(spark, table):
        # The other publisher commits between our look and our pointer, once.
        found = numbers(spark, table)
        if not seen:
            seen.append(1)
            T.publish(spark.range(2), t)
        return found

    staged = T.stage(spark.range(3), t)
    monkeypatch.setattr(T, "_numbers", late)
    T.switch(spark, staged, t)
    monkeypatch.setattr(T, "_numbers", numbers)
    assert rows(T.read_table(spark, t, 2)) == [0, 1] and rows(T.read_table(spark, t)) == [0, 1, 2]
    with pytest.raises(T.PublishConflict):
        T.commit(spark, t, {"": "x"}, spark.range(1).schema, follows=2)
    assert T.current(spark, t).number == 3


def test_no_folder_is_renamed(spark, tmp_uri):
    t = f"{tmp_uri}/t"
    T.publish(spark.range(4), t)
    files = {f: os.stat(f).st_ino for f in glob.glob(f"{t}/*/*.parquet")}
    T.publish(spark.range(6), t)
    assert {f: os.stat(f).st_ino for f in files} == files


def test_expiry_keeps_what_a_kept_version_names(spark, tmp_uri):
    t = f"{tmp_uri}/t"
    for n in range(1, 5):
        T.publish(spark.range(n), t)
    assert [v.number for v in T.history(spark, t)] == [3, 4]
    assert rows(T.read_table(spark, t)) == [0, 1, 2, 3] and len(glob.glob(f"{t}/*/_SUCCESS")) == 2
    shared = T.current(spark, t)
    extra = T.stage(spark.range(2), t)
    both = {"a": shared.parts[""], "b": os.path.basename(extra)}
    for _ in range(3):
        T.commit(spark, t, both, shared.schema)
    T.expire(spark, t)
    assert rows(T.read_table(spark, t)) == [0, 0, 1, 1, 2, 3]
    left = T.stage(spark.range(1), t)
    assert T.expire(spark, t) == [] and os.path.isdir(left)    # another publisher's work
    assert T.expire(spark, t, orphan_hours=0) == [os.path.basename(left)] and not os.path.isdir(left)


def test_parts_schema_and_plain_folders(spark, tmp_uri):
    t = f"{tmp_uri}/t"
    df = spark.range(10).selectExpr("id", "cast(id % 2 as string) as p")
    T.publish(df, t, partition_by=["p"])
    assert T.read_table(spark, t).schema["p"].dataType.simpleString() == "string" and T.read_table(spark, t).count() == 10
    T.commit(spark, t, {}, df.schema)
    assert T.read_table(spark, t).count() == 0
    with pytest.raises(ValueError):
        T.read_table(spark, t, 99)
    df.write.parquet(f"{tmp_uri}/plain")
    assert T.read_table(spark, f"{tmp_uri}/plain").count() == 10
