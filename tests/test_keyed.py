import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from hazardlake.sources.keyed import WRITTEN, KeyedTable

SCHEMA = StructType([StructField("k", LongType()), StructField("name", StringType()), StructField("v", DoubleType())])


def keyed(tmp_path, buckets=8):
    return KeyedTable(str(tmp_path / "table"), SCHEMA, ["k"], buckets)


def load(spark, rows):
    return spark.createDataFrame(rows, "k bigint, name string, v double, seq bigint")


def held(table, spark, at=None):
    return {r.k: (r.name, r.v) for r in table.read(spark, at).collect()}


def test_loads_in_any_order_leave_the_newest_write(spark, tmp_path):
    rng = random.Random(3)
    table = keyed(tmp_path)
    first = [(k, f"n{k}", float(k)) for k in range(60)] + [(None, "null key", 0.0)]
    table.load(spark.createDataFrame(first, SCHEMA))
    expected = {k: (0, name, v) for k, name, v in first}
    loads = []
    for seq in range(1, 3):
        keys = rng.sample(range(80), 15)
        loads.append([(k, f"l{seq}", float(seq * 100 + k), seq) for k in keys])
        for k, name, v, _ in loads[-1]:
            expected[k] = max(expected.get(k, (0, "", 0.0)), (seq, name, v))
    for i in (1, 0, 1):  # late and repeated loads undo nothing
        table.upsert(load(spark, loads[i]), "seq")
    assert held(table, spark) == {k: v[1:] for k, v in expected.items()}


def test_only_touched_buckets_are_rewritten_and_snapshots_stay(spark, tmp_path):
    table = keyed(tmp_path)
    table.load(spark.createDataFrame([(k, "a", 0.0) for k in range(40)], SCHEMA))
    number, before = table.versions(spark)
    running = table.read(spark)  # a reader that started before the change
    after = table.upsert(load(spark, [(7, "b", 1.0, 1)]), "seq")
    changed = {b for b, v in table.versions(spark)[1].items() if v != before[b]}
    assert after == number + 1 and len(changed) == 1
    assert {r.name for r in running.collect()} == {"a"}
    assert held(table, spark)[7] == ("b", 1.0) and held(table, spark, at=number)[7] == ("a", 0.0)
    assert table.upsert(load(spark, []), "seq") == after  # nothing to write


def test_a_change_that_fails_halfway_is_never_seen(spark, tmp_path, monkeypatch):
    table = keyed(tmp_path)
    table.load(spark.createDataFrame([(k, "a", 0.0) for k in range(20)], SCHEMA))

    def crash(*_, **__):
        raise RuntimeError("lost before the manifest")

    changes = load(spark, [(k, "half", 9.0, 1) for k in range(20)])
    with monkeypatch.context() as patch:
        patch.setattr(type(spark), "createDataFrame", crash)  # the rows are written, their manifest is not
        with pytest.raises(RuntimeError, match="manifest"):
            table.upsert(changes, "seq")
    assert len(list((tmp_path / "table" / "data").glob("*/_version=2"))) == 8
    assert {name for name, _ in held(table, spark).values()} == {"a"}
    table.upsert(load(spark, [(3, "b", 1.0, 2)]), "seq")  # takes the same number; leftovers of other buckets stay unseen
    assert sorted(name for name, _ in held(table, spark).values()) == ["a"] * 19 + ["b"]


def test_empty_tables_merges_that_empty_and_vacuum(spark, tmp_path):
    table = keyed(tmp_path)
    assert table.read(spark).count() == 0 and table.read(spark).columns == ["k", "name", "v"]
    table.load(spark.createDataFrame([(k, "a", 0.0) for k in range(20)], SCHEMA))
    for seq in (1, 2):
        table.upsert(load(spark, [(k, f"l{seq}", 0.0, seq) for k in range(20)]), "seq")
    before = held(table, spark)
    assert table.vacuum(spark, keep=1) > 0 and held(table, spark) == before
    assert table.vacuum(spark, keep=1) == 0
    everything = load(spark, [(k, "x", 0.0, 9) for k in range(20)]).withColumnRenamed("seq", WRITTEN)
    table.change(everything, lambda old, new: old.filter(F.lit(False)))
    assert held(table, spark) == {}
    table.upsert(load(spark, [(1, "again", 0.0, 10)]), "seq")
    assert held(table, spark) == {1: ("again", 0.0)}
