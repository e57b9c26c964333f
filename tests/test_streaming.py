from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import d, m, rows
from tallyline.streaming import daily, upsert, validate

EVENTS = "ts timestamp_ntz, order_id string, quantity int, line_revenue decimal(12,2)"


def at(day, hour=12):
    return datetime(2024, 1, day, hour)


def land(spark, path, name, data, schema=EVENTS):
    spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(str(path))


def source(spark, path, schema=EVENTS):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(path))


def test_daily_sales_equals_batch_for_all_days(spark, tmp_path):
    src = tmp_path / "in"
    land(spark, src, "a", [(at(1), "o1", 1, m("5")), (at(1), "o1", 2, m("7")), (at(2), "o2", 1, m("1")), (at(4), "o3", 1, m("2"))])
    land(spark, src, "b", [(at(3), "o4", 1, m("9")), (at(8), "o5", 1, m("4")), (at(1), "o1", 1, m("1"))])
    out, state = str(tmp_path / "out"), str(tmp_path / "state")

    def run():
        daily.stream_daily_sales(source(spark, src), out, state, "ts", "order_id", "line_revenue", "quantity").awaitTermination()
        return rows(daily.read_daily_sales(spark, out))

    def batch():
        return rows(daily.daily_sales(spark.read.schema(EVENTS).parquet(str(src)), "ts", "order_id", "line_revenue", "quantity"))

    first = run()
    assert first == batch() and first[0] == (d("2024-01-01"), 1, 4, m("13.00"))
    # rows far behind count as well; the next run resumes from its checkpoint
    land(spark, src, "c", [(at(1), "late", 1, m("100")), (at(12), "o6", 1, m("3"))])
    second = run()
    assert second == batch() and second[0] == (d("2024-01-01"), 2, 5, m("113.00"))


def test_guard_splits_batch_and_stream_alike(spark, tmp_path):
    data = [(at(1), "o1", 1, m("5")), (at(1), "o2", 0, m("5")), (at(1), "o3", 1, m("-1")), (at(1), "o4", -1, m("-2")),
            (at(1), "o5", None, None)]
    land(spark, tmp_path / "in", "a", data)
    good, bad = validate.validate_split(spark.read.schema(EVENTS).parquet(str(tmp_path / "in")), validate.item_rules())
    assert rows(good, "order_id") == [("o1",), ("o5",)]
    assert rows(bad, "order_id", "reason") == [
        ("o2", "non-positive quantity"), ("o3", "negative revenue"), ("o4", "negative revenue")]
    validate.stream_validate(source(spark, tmp_path / "in"), str(tmp_path / "good"), str(tmp_path / "bad"),
                             str(tmp_path / "state"), validate.item_rules()).awaitTermination()
    assert rows(spark.read.parquet(str(tmp_path / "good")).drop("batch")) == rows(good)
    assert rows(spark.read.parquet(str(tmp_path / "bad")).drop("batch")) == rows(bad)


def test_upsert_keeps_the_newest_version(spark, tmp_path):
    schema = "order_id string, status string, v int"
    src, out = tmp_path / "in", str(tmp_path / "out")
    land(spark, src, "a", [("o1", "new", 1), ("o1", "paid", 2), ("o2", "new", 1)], schema)
    upsert.stream_upsert(source(spark, src, schema), out, str(tmp_path / "state"), "order_id", "v").awaitTermination()
    first = upsert.read_upserted(spark, out, "order_id", "v")
    assert rows(first, "order_id", "status") == [("o1", "paid"), ("o2", "new")]
    assert first.where("updated_at is null").count() == 0
    land(spark, src, "b", [("o2", "sent", 3), ("o1", "stale", 1), ("o3", "new", 1)], schema)
    upsert.stream_upsert(source(spark, src, schema), out, str(tmp_path / "state"), "order_id", "v").awaitTermination()
    current = upsert.read_upserted(spark, out, "order_id", "v")
    assert rows(current, "order_id", "status", "v") == [("o1", "paid", 2), ("o2", "sent", 3), ("o3", "new", 1)]
    upsert.compact_upserts(spark, out, str(tmp_path / "compact"), "order_id", "v")
    assert rows(upsert.read_upserted(spark, str(tmp_path / "compact"), "order_id", "v")) == rows(current)


def folders(path):
    return {str(p.relative_to(path)): p.stat().st_mtime_ns for p in path.rglob("*.parquet")}


def test_days_close_and_late_rows_are_accounted_for(spark, tmp_path):
    src, out, state = tmp_path / "in", tmp_path / "out", str(tmp_path / "state")

    def run():
        daily.stream_daily_windows(source(spark, src), str(out), state, "ts", "order_id", "line_revenue", "quantity",
                                   delay_days=2).awaitTermination()
        return rows(daily.read_daily_windows(spark, str(out)).drop("late_rows"))

    def batch():
        return rows(daily.daily_sales(spark.read.schema(EVENTS).parquet(str(src)), "ts", "order_id", "line_revenue", "quantity"))

    land(spark, src, "a", [(at(1), "o1", 1, m("5")), (at(1), "o1", 2, m("7")), (at(2), "o2", 1, m("1")), (at(4), "o3", 1, m("2"))])
    assert run() == batch()
    assert sorted(p.name for p in (out / "closed").glob("order_date=*")) == ["order_date=2024-01-01"]
    land(spark, src, "b", [(at(3), "o4", 1, m("9")), (at(2), "o2", 1, m("3")), (at(9), "o5", 1, m("4"))])
    assert run() == batch()
    closed = folders(out / "closed")
    assert {p.split("/")[0] for p in closed} == {f"order_date=2024-01-0{i}" for i in (1, 2, 3, 4)}
    # rows for closed days, one of a known order and one of a new one, and one without a time
    land(spark, src, "c", [(at(1), "o1", 1, m("100")), (at(3), "late", 1, m("3")), (at(8), "o6", 1, m("1")), (None, "o7", 1, m("1"))])
    assert run() == batch()
    assert folders(out / "closed") == closed                       # what is closed is not written again
    late = {r.order_date: r.late_rows for r in daily.read_daily_windows(spark, str(out)).collect()}
    assert late[d("2024-01-01")] == 1 and late[d("2024-01-03")] == 1 and late[None] == 1 and late[d("2024-01-08")] == 0
    still = {p.name for p in (out / "open").glob("order_date=*")}
    assert "order_date=2024-01-01" not in still and "order_date=2024-01-09" in still


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    src, out, state = tmp_path / "in", str(tmp_path / "out"), tmp_path / "state"
    land(spark, src, "a", [(at(1), "o1", 1, m("5")), (at(9), "o2", 1, m("1"))])

    def run():
        daily.stream_daily_windows(source(spark, src), out, str(state), "ts", "order_id", "line_revenue").awaitTermination()
        return rows(daily.read_daily_windows(spark, out))
    first = run()
    land(spark, src, "b", [(at(1), "o1", 1, m("5")), (at(12), "o3", 1, m("1"))])
    second = run()
    for crc in (state / "commits").glob("*1*"):
        crc.unlink()                                               # as if the last batch had not been committed
    assert run() == second != first


def test_buckets_hold_one_row_per_key_and_untouched_ones_keep_their_files(spark, tmp_path):
    schema = "order_id string, status string, v int"
    src, out, state = tmp_path / "in", tmp_path / "out", tmp_path / "state"

    def run():
        stream = source(spark, src, schema)
        upsert.stream_upsert_buckets(stream, str(out), str(state), "order_id", "v", buckets=16).awaitTermination()
        return upsert.read_buckets(spark, str(out), stream.schema)

    land(spark, src, "a", [(f"o{i}", "new", 1) for i in range(40)] + [("o1", "paid", 2), (None, "lost", 1)], schema)
    first = run()
    assert first.count() == 40 and rows(first.where("order_id = 'o1'"), "status", "v") == [("paid", 2)]
    before = folders(out)
    land(spark, src, "b", [("o1", "stale", 1), ("o2", "sent", 3)], schema)
    second = run()
    assert second.count() == 40 and rows(second.where("v > 1"), "order_id", "status") == [("o1", "paid"), ("o2", "sent")]
    after = folders(out)
    assert all(after[p] == t for p, t in before.items())            # nothing is overwritten in place
    new = {p.split("/")[1] for p in set(after) - set(before)}
    assert 1 <= len(new) <= 2                                       # only the buckets of o1 and o2
    read = {f.split("bucket=")[1].split("/")[0]: f.split("version=")[1].split("/")[0] for f in second.inputFiles()}
    assert len(read) == len({p.split("/")[1] for p in before}) and {v for b, v in read.items() if f"bucket={b}" in new} == {"1"}
    # a batch that is repeated after a failure writes the same again
    want = rows(second.drop("updated_at"))
    for name in (state / "commits").glob("*1*"):
        name.unlink()
    assert rows(run().drop("updated_at")) == want
    assert upsert.vacuum_buckets(spark, str(out), keep=1) == len(new)
    assert rows(run().drop("updated_at")) == want
