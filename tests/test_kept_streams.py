"""Streams that run for long: dates packed in place, reports as rows, restarts after failures."""

import datetime

import pytest
from pyspark.sql import functions as F

from hazardlake.streaming import compaction
from hazardlake.streaming.compaction import compact_closed
from hazardlake.streaming.progress import ProgressLog, run_supervised
from hazardlake.streaming.sinks import Output, fan_out, run_available

SCHEMA = "id int, year int, month int, day int"
TOMORROW = datetime.date(2024, 1, 3)


@pytest.fixture
def table(spark, tmp_path):
    """A stream of files, its table, and what feeds it: a file a micro-batch with rows of two dates."""
    folder, out, state = (str(tmp_path / name) for name in ("in", "out", "state"))

    def feed(*ids):
        for i in ids:
            rows = [(2 * i, 2024, 1, 1), (2 * i + 1, 2024, 1, 2), (-i, 2024, 1, 3), (1000 + i, None, 1, 1)]
            spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)

    def run():
        rows = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)
        run_available(fan_out(rows, [Output(out, lambda b: b)], state))

    def ids():
        return sorted(r.id for r in spark.read.parquet(out).collect())

    feed(1, 2, 3)
    run()
    return feed, run, ids, tmp_path / "out", tmp_path / "state"


def expected(*numbers):
    return sorted(x for i in numbers for x in (2 * i, 2 * i + 1, -i, 1000 + i))


def leaves(out, date):
    return sorted(p.name for p in out.glob(f"{date}/*/*"))


def test_closed_dates_are_packed_and_the_stream_goes_on(spark, table):
    feed, run, ids, out, state = table
    assert compact_closed(spark, str(out), str(state), TOMORROW) == 6
    assert leaves(out, "year=2024/month=1/day=1") == ["batch_id=-3"] and ids() == expected(1, 2, 3)
    assert len(leaves(out, "year=2024/month=1/day=3")) == 3  # not closed
    assert len(leaves(out, "year=__HIVE_DEFAULT_PARTITION__/month=1/day=1")) == 3  # no date
    assert compact_closed(spark, str(out), str(state), TOMORROW) == 0
    feed(4, 5)
    run()
    assert ids() == expected(1, 2, 3, 4, 5)
    assert compact_closed(spark, str(out), str(state), TOMORROW) == 6  # late rows join the packed ones
    assert leaves(out, "year=2024/month=1/day=2") == ["batch_id=-5"] and ids() == expected(1, 2, 3, 4, 5)
    assert len(list(out.glob("year=2024/month=1/day=2/*/*/*.parquet"))) == 1


def test_a_batch_that_may_run_again_is_left_alone(spark, table):
    _, run, ids, out, state = table
    for name in ("2", ".2.crc"):
        (state / "commits" / name).unlink(missing_ok=True)
    assert compact_closed(spark, str(out), str(state), TOMORROW) == 4
    assert leaves(out, "year=2024/month=1/day=1") == ["batch_id=-2", "batch_id=2"]
    run()  # batch 2 once more
    assert ids() == expected(1, 2, 3)


def test_other_streams_of_a_table_are_left_alone(spark, table, tmp_path):
    _, _, ids, out, state = table
    rows = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    run_available(fan_out(rows, [Output(str(out), lambda b: b)], str(tmp_path / "other")))
    assert compact_closed(spark, str(out), str(state), TOMORROW) == 6
    assert len(leaves(out, "year=2024/month=1/day=1")) == 4 and ids() == sorted(expected(1, 2, 3) * 2)


@pytest.mark.parametrize("steps", [0, 1, 2, 5])
def test_a_swap_that_dies_is_finished_by_the_next_call(spark, table, monkeypatch, steps):
    _, _, ids, out, state = table
    left = [steps]

    def failing(name):
        real = getattr(compaction._Folder, name)

        def step(self, *names):
            if left[0] == 0:
                raise OSError("lost")
            left[0] -= 1
            real(self, *names)

        return step

    with monkeypatch.context() as patched:
        for name in ("move", "delete"):
            patched.setattr(compaction._Folder, name, failing(name))
        with pytest.raises(OSError, match="lost"):
            compact_closed(spark, str(out), str(state), TOMORROW)
    compact_closed(spark, str(out), str(state), TOMORROW)
    assert ids() == expected(1, 2, 3) and leaves(out, "year=2024/month=1/day=1") == ["batch_id=-3"]
    assert not (out / compaction.WORK).exists()


def test_rows_that_do_not_arrive_stop_the_swap(spark, table, monkeypatch):
    _, _, ids, out, state = table
    real = compaction._rows
    monkeypatch.setattr(compaction, "_rows", lambda s, path, *rest: real(s, path, *rest).limit(3 if path.endswith("data") else 10**6))
    with pytest.raises(RuntimeError, match="differ in number"):
        compact_closed(spark, str(out), str(state), TOMORROW)
    assert ids() == expected(1, 2, 3)


def test_a_failed_batch_is_run_again_and_reported(spark, tmp_path):
    folder, state, seen = str(tmp_path / "in"), str(tmp_path / "state"), []
    spark.range(5).coalesce(1).write.parquet(folder)

    def write(batch, number):
        seen.append(number)
        if len(seen) == 1:
            raise ValueError("first try")
        batch.write.mode("overwrite").parquet(str(tmp_path / f"out-{number}"))

    def start():
        rows = spark.readStream.schema("id bigint").parquet(folder)
        return rows.writeStream.option("checkpointLocation", state).foreachBatch(write)

    with ProgressLog(spark, str(tmp_path / "log")) as log:
        query = run_supervised(start, "0 seconds", until=lambda q: (tmp_path / "state/commits/0").exists(), poll=0.2)
        log.wait_for(query)
    assert seen == [0, 0] and spark.read.parquet(str(tmp_path / "out-0")).count() == 5
    rows = log.table().orderBy("at").collect()
    assert [r.event for r in rows if r.event != "batch"] == ["started", "failed", "started", "stopped"]
    assert len({r.query_id for r in rows}) == 1 and len({r.run_id for r in rows}) == 2
    assert "first try" in next(r.problem for r in rows if r.event == "failed")
    assert [(r.batch_id, r.n_input) for r in rows if r.event == "batch" and r.n_input] == [(0, 5)]


def test_a_stream_that_keeps_failing_is_raised(spark, tmp_path):
    folder = str(tmp_path / "in")
    spark.range(5).coalesce(1).write.parquet(folder)
    tries = []

    def write(batch, number):
        tries.append(number)
        raise ValueError("always")

    def start():
        rows = spark.readStream.schema("id bigint").parquet(folder)
        return rows.writeStream.option("checkpointLocation", str(tmp_path / "state")).foreachBatch(write)

    with pytest.raises(Exception, match="always"):
        run_supervised(start, "0 seconds", restarts=2, poll=0.2)
    assert tries == [0, 0, 0]


def test_late_rows_are_counted(spark, tmp_path):
    folder, state, out = (str(tmp_path / name) for name in ("in", "state", "out"))
    schema = "k string, ts timestamp"

    def run(*rows):
        spark.createDataFrame(rows, "k string, t string").select("k", F.col("t").cast("timestamp").alias("ts")).coalesce(1).write.mode(
            "append"
        ).parquet(folder)
        stream = spark.readStream.schema(schema).parquet(folder).withWatermark("ts", "1 second")
        counts = stream.groupBy(F.window("ts", "1 minute"), "k").count()
        log.wait_for(run_available(counts.writeStream.format("parquet").option("path", out).option("checkpointLocation", state)))

    with ProgressLog(spark, str(tmp_path / "log")) as log:
        run(("a", "2024-01-01 00:00:01"), ("a", "2024-01-01 01:00:00"))
        run(("a", "2024-01-01 00:00:05"), ("a", "2024-01-01 00:00:06"), ("b", "2024-01-01 00:00:07"), ("b", "2024-01-01 02:00:00"))
    table = log.table()
    assert table.agg(F.sum("n_dropped")).first()[0] == 2  # two late groups
    assert table.filter("event = 'batch'").agg(F.sum("n_input")).first()[0] == 6
