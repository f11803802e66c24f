"""Loads as one commit over several tables, buckets by key, packing, vacuum and concurrent writers."""

import datetime as dt
import threading

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from tidemark.operators import commits, load
from tidemark.operators.tables import Conflict, Table, first_fit
from tidemark.sources import landing

STAFF, OFFICES = landing.REGISTRY["staff"], landing.REGISTRY["offices"]
TYPES = {"id": "long", "int": "int", "flag": "int", "text": "string", "date": "date", "money": "decimal(19,6)"}
AT = [dt.datetime(2026, 1, n) for n in range(1, 9)]


def rows_of(df, entity, **columns):
    """The entity's columns, those that aren't given NULL."""
    return df.select(*[columns.get(c, F.lit(None)).cast(TYPES[k]).alias(c) for c, k in entity.columns.items()])


def people(spark, names):
    return rows_of(spark.createDataFrame(names, "k long, v string"), STAFF, staff_id=F.col("k"), display_name=F.col("v"))


def content(lake, *skip):
    names = [n for n in ("staff", "rejects", "expectations", "watermarks", "runs") if n not in skip]
    return {n: sorted(map(str, lake.table(n).read().collect())) for n in names if lake.table(n).exists()}


def test_a_failure_at_any_step_leaves_a_failed_run_alone(spark, tmp_path, monkeypatch):
    lake = load.Lake(spark, str(tmp_path / "lake"))
    hundred = [(k, f"n{k}") for k in range(1, 100)]
    assert lake.load(STAFF, people(spark, [*hundred, (-1, "bad")]), AT[0], "first").status == "success"
    before, runs = content(lake, "runs"), lake.table("runs").read().count()
    assert set(before) == {"staff", "rejects", "expectations", "watermarks"} and runs == 1
    stage, commit = commits.LogTable.stage, commits.Log.commit
    calls = {"n": 0, "at": None}

    def failing_stage(self, *args, **kw):
        calls["n"] += 1
        if calls["n"] == calls["at"]:
            raise OSError("the store is away")
        return stage(self, *args, **kw)

    changed = people(spark, [*hundred[1:], (1, "other"), (500, "new"), (-2, "bad")])
    monkeypatch.setattr(commits.LogTable, "stage", failing_stage)
    for k in range(2, 7):  # the first is the record of the running run
        calls.update(n=0, at=k)
        out = lake.load(STAFF, changed, AT[1], f"fails at {k}")
        assert out.status == "failed" and "store is away" in out.error, k
        assert content(lake, "runs") == before
    monkeypatch.setattr(commits.LogTable, "stage", stage)

    def failing_commit(self, changes, said=""):
        if "staff" in changes:
            raise OSError("no commit")
        return commit(self, changes, said)

    monkeypatch.setattr(commits.Log, "commit", failing_commit)
    assert lake.load(STAFF, changed, AT[2]).status == "failed" and content(lake, "runs") == before
    monkeypatch.setattr(commits.Log, "commit", commit)
    assert [r.status for r in lake.table("runs").read().orderBy("started_at").collect()] == ["success", *["failed"] * 6]
    assert lake.load(STAFF, changed, AT[3], "last") == load.Outcome("staff", "success", 100, 1, 1, 98, 1)
    assert lake.table("rejects").read().count() == 2 and lake.table("watermarks").read().first().total_rows_loaded == 199
    last = lake.table("runs").read().where("batch_id = 'last'").first()
    assert last.status == "success" and last.finished_at > last.started_at == AT[3]


def test_a_killed_load_shows_as_running(spark, tmp_path, monkeypatch):
    lake = load.Lake(spark, str(tmp_path / "lake"))
    lake.load(STAFF, people(spark, [(1, "a")]), AT[0])
    before = content(lake, "runs")

    def killed(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(load.Lake, "_merged", killed)
    with pytest.raises(KeyboardInterrupt):
        lake.load(STAFF, people(spark, [(2, "b")]), AT[1], "killed")
    assert content(lake, "runs") == before
    row = lake.table("runs").read().where("batch_id = 'killed'").first()
    assert row.status == "running" and row.finished_at is None and row.started_at == AT[1]
    monkeypatch.undo()
    assert lake.load(STAFF, people(spark, [(2, "b")]), AT[2]).status == "success" and {r.staff_id for r in lake.table("staff").read().collect()} == {1, 2}


def test_two_loads_at_once_both_land(spark, tmp_path):
    lake, out = load.Lake(spark, str(tmp_path / "lake")), []
    lake.load(STAFF, people(spark, [(k, "a") for k in range(20)]), AT[0])
    batches = [(STAFF, people(spark, [(k, "b") for k in range(10)])), (STAFF, people(spark, [(k, "c") for k in range(10, 30)])), (OFFICES, rows_of(spark.range(3), OFFICES, office_id=F.col("id"), name=F.lit("o")))]
    threads = [threading.Thread(target=lambda e=e, rows=rows: out.append(lake.load(e, rows, AT[1]))) for e, rows in batches]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted((o.entity, o.status, o.inserted, o.updated) for o in out) == [("offices", "success", 3, 0), ("staff", "success", 0, 10), ("staff", "success", 10, 10)], out
    assert {(r.staff_id, r.display_name) for r in lake.table("staff").read().collect()} == {(k, "b" if k < 10 else "c") for k in range(30)}
    assert lake.table("runs").read().where("status = 'success'").count() == 4 and lake.table("offices").read().count() == 3
    assert {r.entity: r.total_rows_loaded for r in lake.table("watermarks").read().collect()} == {"staff": 50, "offices": 3}


def test_one_changed_key_of_a_million_rewrites_one_bucket(spark, tmp_path):
    lake = load.Lake(spark, str(tmp_path / "lake"), bucket_rows=1 << 16)
    million = lambda changed: rows_of(spark.range(1_000_000), STAFF, staff_id=F.col("id"), display_name=F.when(F.col("id") == changed, "other").otherwise("same"))
    assert lake.load(STAFF, million(-1), AT[0]).inserted == 1_000_000
    folders = lambda: {x["part"]: x["path"] for x in lake.table("staff").pointer()["folders"]}
    old = folders()
    assert len(old) == 16 and lake.table("staff").pointer()["rows"] == 1_000_000
    assert lake.load(STAFF, million(77), AT[1]) == load.Outcome("staff", "success", 1_000_000, 0, 1, 999_999)
    new = folders()
    assert len([p for p in old if old[p] != new[p]]) == 1 and lake.table("staff").read().count() == 1_000_000
    assert lake.load(STAFF, people(spark, [(77, "third")]), AT[2]) == load.Outcome("staff", "success", 1, 0, 1, 0)
    row = lake.table("staff").read().where("staff_id = 77").first()
    assert (row.display_name, row._ingested_at, row._updated_at) == ("third", AT[0], AT[2])


def test_a_table_that_outgrows_its_buckets_gets_more(spark, tmp_path):
    lake = load.Lake(spark, str(tmp_path / "lake"), bucket_rows=10)
    assert lake.load(STAFF, people(spark, [(k, "a") for k in range(10)]), AT[0]).inserted == 10
    assert lake.load(STAFF, people(spark, [(k, "b") for k in range(5, 80)]), AT[1]) == load.Outcome("staff", "success", 75, 70, 5, 0)
    assert lake.table("staff").pointer()["buckets"] == ["staff_id", 8]
    assert lake.load(STAFF, people(spark, [(k, "b") for k in range(80)]), AT[2]) == load.Outcome("staff", "success", 80, 0, 5, 75)
    assert sorted(r.staff_id for r in lake.table("staff").read().collect()) == list(range(80))


def test_a_first_load_of_a_known_size_is_written_once(spark, tmp_path, monkeypatch):
    rows = [(k, f"n{k % 50}") for k in range(200)]
    twice = people(spark, [*rows, *rows[:20]]).withColumn("_nth", F.when(F.col("staff_id") < 5, 2).otherwise(1)).unionByName(people(spark, [(1, "older"), *[(-1, "bad")] * 3, (None, "none")]).withColumn("_nth", F.lit(0)))
    written, parquet = [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path, *args, **kw: (written.append(path), parquet(self, path, *args, **kw))[1])
    got = {}
    for name, expected in (("known", 224), ("unknown", None)):
        lake = load.Lake(spark, str(tmp_path / name), bucket_rows=64)
        written.clear()
        assert lake.load(STAFF, twice, AT[0], "first", "_nth", expected=expected) == load.Outcome("staff", "success", 200, 200, rejected=4)
        assert len([x for x in written if "/batches/" in x or "/staff/" in x]) == (1 if expected else 2)
        assert sorted(x["part"] for x in lake.table("staff").pointer()["folders"]) == ["0", "1", "2", "3"] and lake.table("staff").read().columns == [*STAFF.columns, load.HASH, "_ingested_at", "_updated_at"]
        assert sorted(r.source_key or "" for r in lake.table("rejects").read().collect()) == ["", "-1", "-1", "-1"]
        assert lake.load(STAFF, people(spark, [(1, "n1"), (2, "new"), (700, "more")]), AT[1], expected=3) == load.Outcome("staff", "success", 3, 1, 1, 1)
        got[name] = content(lake, "runs", "rejects", "expectations")
    assert got["known"] == got["unknown"] and len(got["known"]["staff"]) == 201
    lake = load.Lake(spark, str(tmp_path / "bad"))
    assert lake.load(STAFF, people(spark, [(-1, "bad")]), AT[0], expected=1).status == "failed"
    assert not lake.table("staff").exists() and not lake.log.store.names(f"{lake.path}/staff/data") and not lake.log.store.names(f"{lake.path}/staff/staging")
    none = people(spark, [(1, "a")]).where("false")
    assert lake.load(STAFF, none, AT[1], None, "staff_id", expected=0).status == "success" and lake.table("staff").read().count() == 0


def test_a_first_load_is_shuffled_once_and_mapped_after(spark, tmp_path, monkeypatch):
    rows = spark.createDataFrame([*[(k, f"n{k}", 2) for k in range(1, 201)], *[(k, "older", 1) for k in range(1, 51)], (-1, "bad", 1), (-1, "bad", 1), (None, "none", 1)], "k long, v string, _nth int")
    made = {c: F.lit(None).cast(TYPES[k]) for c, k in STAFF.columns.items()} | {"staff_id": F.col("k"), "display_name": F.col("v"), "office_id": (F.col("k") * 10).cast("long"), "lastname": F.concat(F.lit("of "), "v")}
    typed = rows.select(*[made[c].alias(c) for c in STAFF.columns], "_nth")
    plans, stage, got = [], commits.LogTable.stage, {}

    def watched(self, df, *args, **how):
        plans.extend([df._jdf.queryExecution().optimizedPlan().toString()] if self.name == "staff" else [])
        assert self.name != "staff" or how.get("dealt")
        return stage(self, df, *args, **how)

    monkeypatch.setattr(commits.LogTable, "stage", watched)
    for name, df, mapping in (("typed", typed, None), ("mapped", rows, made)):
        lake = load.Lake(spark, str(tmp_path / name), bucket_rows=64)
        assert lake.load(STAFF, df, AT[0], "first", "_nth", expected=253, mapping=mapping) == load.Outcome("staff", "success", 200, 200, rejected=3)
        assert sorted(x["part"] for x in lake.table("staff").pointer()["folders"]) == ["0", "1", "2", "3"]
        got[name] = content(lake, "runs", "rejects")
        assert sorted((r.source_key, r.rule) for r in lake.table("rejects").read().where("source_key is not null").collect()) == [("-1", "primary_key_positive")] * 2
        assert lake.load(STAFF, df, AT[1], "again", "_nth", mapping=mapping) == load.Outcome("staff", "success", 200, 0, 0, 200, 3)
    assert got["typed"] == got["mapped"] and len(got["mapped"]["staff"]) == 200
    assert [(p.count("RepartitionByExpression"), p.count("Rebalance")) for p in plans] == [(1, 0)] * 2


def test_backfill_tells_of_rows_and_parents_of_loans(spark, tmp_path):
    lake, loans = load.Lake(spark, str(tmp_path / "lake")), landing.REGISTRY["loans"]
    frame = lambda n: rows_of(spark.range(n), loans, loan_id=F.col("id"), client_id=F.lit(1), disbursed_on_date=F.when(F.col("id") % 2 == 0, F.lit(AT[0])))
    lake.load(loans, frame(4), AT[0])
    got = lake.backfill(lambda name: {"loans": frame(6)}[name], AT[1], ["loans"])
    assert [tuple(r) for r in got.select("entity", "rows_before", "rows_after", "shrank").collect()] == [("loans", 4, 6, False)]
    assert [r.loan_id for r in lake.parents().collect()] == [4, 0, 2] and [r.loan_id for r in lake.parents(1).collect()] == [4]


def test_vacuum_spares_what_is_being_written(spark, tmp_path):
    t = Table(spark, str(tmp_path / "t"))
    for k in range(3):
        t.replace(spark.createDataFrame([(k, "a")], "k long, v string"))
    staged = t.stage(spark.createDataFrame([(9, "late")], "k long, v string"))
    assert t.vacuum(keep=1) == 2
    t.publish(staged, "k long, v string")
    assert [tuple(r) for r in t.read().collect()] == [(9, "late")] and t.store.names(f"{t.path}/staging") == []
    lost = t.stage(spark.createDataFrame([(8, "lost")], "k long, v string"))
    assert t.vacuum(keep=1, grace_hours=-1) == 2 and lost[0]["path"].split("/")[1] not in t.store.names(f"{t.path}/data")
    lake = load.Lake(spark, str(tmp_path / "lake"))
    for k in range(3):
        lake.load(STAFF, people(spark, [(1, f"v{k}")]), AT[k])
    staged = lake.table("staff").stage(spark.range(1).toDF("staff_id"))
    assert lake.vacuum(keep=1) > 0 and len(lake.log.numbers()) == 1 and lake.table("staff").versions() == [3]
    assert lake.table("staff").read().first().display_name == "v2" and lake.table("runs").read().count() == 3
    assert staged[0]["path"].split("/")[1] in lake.log.store.names(f"{lake.path}/staff/data")


def test_appends_from_two_writers_land_and_folders_stay_few(spark, tmp_path):
    a, b = Table(spark, str(tmp_path / "t")), Table(spark, str(tmp_path / "t"))
    one = lambda k: spark.createDataFrame([(k,)], "k long").coalesce(1)
    a.replace(one(0))
    seen = a.versions
    stale = [seen()]
    b.append(one(1))
    a.versions = lambda: stale.pop() if stale else seen()  # the first look is from before the other's append
    a.append(one(2))
    assert sorted(r.k for r in b.read().collect()) == [0, 1, 2]
    for k in range(3, 34):
        b.append(one(k))
    assert sorted(r.k for r in b.read().collect()) == list(range(34)) and len(b.pointer()["folders"]) < 16
    with pytest.raises(Conflict):
        b.publish([], "k long", after=5)


def test_packing_leaves_full_files_alone(spark, tmp_path):
    t = Table(spark, str(tmp_path / "t"), "day")
    noise = lambda n, day: spark.range(n).select(F.rand(7).alias("x"), F.lit(day).alias("day"))
    t.replace(noise(40_000, "a").unionByName(noise(10, "c")))
    for _ in range(6):
        t.append(noise(300, "a").unionByName(noise(300, "b")))
    rows = t.read().groupBy("day").count().collect()
    sizes = {f: size for x in t.pointer()["folders"] for f, size in t.files(x)}
    big = max(sizes, key=sizes.get)
    target = int(sizes[big] * 1.5)
    small_c = [x["path"] for x in t.pointer()["folders"] if x["part"] == "c"]
    version = t.pack(target)
    after = {f: size for x in t.pointer()["folders"] for f, size in t.files(x)}
    assert big in after and len(sizes) == 14 and len(after) == 4 and max(after.values()) <= target
    assert [x["path"] for x in t.pointer()["folders"] if x["part"] == "c"] == small_c
    assert sorted(map(tuple, rows)) == sorted(map(tuple, t.read().groupBy("day").count().collect()))
    assert t.pack(target) == version
    t.merge(spark.createDataFrame([(2.0, "b")], "x double, day string"), ["x"])
    assert t.read().count() == sum(r["count"] for r in rows) + 1
    assert first_fit([("a", 5), ("b", 4), ("c", 3), ("d", 1)], 8) == [[("a", 5), ("c", 3)], [("b", 4), ("d", 1)]]
