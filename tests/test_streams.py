"""The message log and the streams over it: offsets, restarts, replays, routing, state."""

import datetime as dt
import json
import threading
import time

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tidemark import queries, shared
from tidemark.operators import cdc, monitor
from tidemark.operators.tables import Table
from tidemark.sources import landing, star
from tidemark.streaming import continuous, topics

AT = dt.datetime(2024, 1, 1)


def send(spark, path, rows, partitions=3):
    df = spark.createDataFrame(rows, "topic string, key long, n long, value string")
    return topics.append(df, path, F.col("key"), [F.col("n")], partitions)


def run(writer):
    q = writer.start()
    assert q.awaitTermination(180)
    return q


def test_offsets_have_no_gaps_and_ranges_meet(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "log")
    assert topics.Reader(path, []).latestOffset() == {}
    assert send(spark, path, [("a", k, k, f"a{k}") for k in range(100)] + [("b", 1, 1, "b1")]) == 1
    jobs = [threading.Thread(target=send, args=(spark, path, [("a", k, k, f"{w}{k}") for k in range(40)])) for w in ("x", "y")]
    for j in jobs:
        j.start()
    for j in jobs:
        j.join()
    reader, end = topics.Reader(path, []), topics.Reader(path, []).latestOffset()
    assert sum(n for k, n in end.items() if k.startswith("a/")) == 180 and sum(n for k, n in end.items() if k.startswith("b/")) == 1
    monkeypatch.setattr(topics, "SPLIT", 7)
    read = lambda lo, hi, which=reader: [r for s in which.partitions(lo, hi) for b in which.read(s) for r in b.to_pylist()]
    rows = read({}, end)
    assert len({(r["topic"], r["partition"], r["offset"]) for r in rows}) == len(rows) == 181
    for k, n in end.items():
        topic, p = k.rsplit("/", 1)
        assert sorted(r["offset"] for r in rows if (r["topic"], r["partition"]) == (topic, int(p))) == list(range(n))
    middle = {k: n // 2 for k, n in end.items()}
    whole = lambda x: sorted((r["topic"], r["partition"], r["offset"], r["value"]) for r in x)
    assert whole(read({}, middle) + read(middle, end)) == whole(rows)
    only = topics.Reader(path, ["b"])
    assert [r["value"] for r in read({}, only.latestOffset(), only)] == ["b1"]


def test_a_partition_is_written_by_several_tasks_in_order(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        send(spark, str(tmp_path / "log"), [("a", k, n := k * 7919 % 1000, f"{n}") for k in range(1000)], 1)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(list((tmp_path / "log" / "data").rglob("*.parquet"))) > 1
    reader = topics.Reader(str(tmp_path / "log"), [])
    rows = [r for s in reader.partitions({}, reader.latestOffset()) for b in reader.read(s) for r in b.to_pylist()]
    assert [(r["offset"], r["value"]) for r in rows] == [(n, f"{n}") for n in range(1000)]


def test_what_is_written_leaves_no_shuffle_files(spark, tmp_path):
    blocks = lambda: {b.toString() for b in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()) if b.isShuffle()}
    old, rows = blocks(), spark.range(1000).selectExpr("id % 7 AS k", "id").groupBy("k").count()
    assert len(shared.written(rows).collect()) == 7
    Table(spark, str(tmp_path / "t"), "k").replace(rows)
    send(spark, str(tmp_path / "log"), [("a", k, k, f"a{k}") for k in range(100)])
    for _ in range(50):  # they go in the background
        if blocks() <= old:
            break
        time.sleep(0.1)
    assert blocks() <= old
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == "false" and len(rows.collect()) == len(rows.collect()) == 7


def test_texts_made_after_rows_are_dealt_out_are_the_same(spark, tmp_path):
    x = queries.Source(spark, "/root/testdata/sf0.001")
    rows, text = queries.messages(x)
    topics.append(rows, str(tmp_path / "log"), F.col("key"), [F.col("at"), F.col("lsn")], 2, text)
    log = spark.read.parquet(str(tmp_path / "log" / "data" / "*"))
    for name, e in landing.REGISTRY.items():
        want = landing.as_events(x.raw(name), e)
        got = log.where(F.col("topic") == name).select("value")
        assert want.count() == got.count() > 0 and not want.exceptAll(got).count()
    columns = next(p for p in (tmp_path / "log").rglob("*.parquet") if "topic=loans/" in str(p))
    assert pq.ParquetFile(columns).metadata.row_group(0).column(0).compression == "ZSTD"
    assert x.raw("loans").columns and len(star.source(spark, x.dir, "loans").columns) < 10 < len(x.raw("loans").columns)


def test_messages_needn_t_stay(spark, tmp_path):
    log, e = str(tmp_path / "log"), landing.REGISTRY["staff"]
    send(spark, log, [("staff", k, 1, json.dumps({e.key: k, "__op": "u"})) for k in range(9)])
    for keep in (True, False):
        out = str(tmp_path / f"out-{keep}")
        run(continuous.land_topics(topics.stream(spark, log), out, f"{out}-checkpoint", {"availableNow": True}, keep=keep))
        assert spark.read.parquet(f"{out}/typed/staff").count() == spark.read.parquet(f"{out}/audit").count() == 9
        assert any((tmp_path / f"out-{keep}" / "messages").rglob("*.parquet")) == keep


def test_a_stream_of_topics_restarts_and_replays(spark, tmp_path):
    log, out, checkpoint = (str(tmp_path / x) for x in ("log", "out", "checkpoint"))
    event = lambda e, k, n: json.dumps({e.key: k, "__op": "u", "__source_ts_ms": n})
    loans, staff = landing.REGISTRY["loans"], landing.REGISTRY["staff"]
    first = [("loans", k, 1, event(loans, k, 1)) for k in range(50)] + [("staff", k, 1, event(staff, k, 1)) for k in range(7)] + [("staff", 9, 2, "{no json"), ("pets", 1, 1, "{}")]
    landed = lambda name: spark.read.parquet(f"{out}/typed/{name}")
    stream = lambda: continuous.land_topics(topics.stream(spark, log), out, checkpoint, {"availableNow": True})
    send(spark, log, first)
    run(stream())
    for f in (tmp_path / "checkpoint" / "commits").iterdir():
        f.unlink()  # as if the run had died before it could say that the batch was done
    send(spark, log, [("loans", k, 2, event(loans, k, 2)) for k in range(30, 60)])
    run(stream())
    run(stream())  # nothing new
    assert landed("loans").count() == 80 and landed("staff").count() == 7
    assert {r._version for r in cdc.newest(landed("loans").drop("stream", "batch"), "loan_id", columns=[]).where("loan_id >= 30").collect()} == {2}
    errors = {(r.topic, r.error, r.raw_message) for r in spark.read.parquet(f"{out}/errors").collect()}
    assert errors == {("staff", "malformed JSON", "{no json"), ("pets", "unknown topic", "{}")}
    bad = spark.read.parquet(f"{out}/errors").where("topic = 'staff'").first()
    assert bad.partition is not None and bad.offset is not None
    assert spark.read.parquet(f"{out}/audit").groupBy("source_table").count().orderBy("source_table").collect() == [("loans", 80), ("staff", 7)]


def test_collapse_holds_in_any_order(spark, tmp_path):
    schema = "k long, v string, _version long, _lsn long, _tx_id long, _is_deleted int"
    rounds = [[(1, "new", 5, 0, 0, 0), (2, "b", 1, 0, 0, 0), (3, "c", 1, 0, 0, 0)], [(1, "old", 2, 0, 0, 0), (2, None, 2, 0, 0, 1), (4, "d", 1, 1, 0, 0), (4, "e", 1, 2, 0, 0)], [(2, "b", 1, 0, 0, 0), (3, "c", 1, 0, 0, 0), (4, "d", 1, 1, 0, 0), (1, "new", 5, 0, 0, 0)]]
    table, got = Table(spark, str(tmp_path / "t"), buckets=("k", 2)), []
    for rows in rounds:
        spark.createDataFrame(rows, schema).write.mode("append").parquet(str(tmp_path / "in"))
        versions = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        run(continuous.collapse(versions, "k", table, str(tmp_path / "checkpoint"), {"availableNow": True}))
        got.append({(r.k, r.v) for r in table.read().collect()})
    assert got == [{(1, "new"), (2, "b"), (3, "c")}, {(1, "new"), (3, "c"), (4, "e")}, {(1, "new"), (3, "c"), (4, "e")}]


def test_late_rows_are_dropped_and_windows_come_once(spark, tmp_path):
    schema = "source_commit_at timestamp, source_table string, op string"
    hours = lambda n: AT + dt.timedelta(hours=n)
    rounds = [[hours(0), hours(100)], [hours(60), hours(10), hours(200)], [hours(100), hours(201), hours(260)]]
    for times in rounds:
        spark.createDataFrame([(t, "t", "u") for t in times], schema).write.mode("append").parquet(str(tmp_path / "in"))
        counts = monitor.rolling_counts(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), "1 hour")
        run(counts.writeStream.format("parquet").outputMode("append").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "checkpoint")).option("path", str(tmp_path / "out")))
    got = {r.window_start: r.events for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    # 10 is over 48 hours behind 100, the second 100 behind 200; what lies within 48 hours of 260 isn't out yet
    assert got == {hours(0): 1, hours(60): 1, hours(100): 1, hours(200): 1, hours(201): 1}


def test_a_broker_is_asked_for_all_topics(spark):
    with pytest.raises(Exception, match="(?i)kafka"):  # no connector on this machine
        continuous.from_kafka(spark, "localhost:9092", ["loans", "staff"])
