"""Layouts that can be seen to skip, statistics from footers, the gate's isolation, histories."""

import datetime as dt

import duckdb
from pyspark.sql import functions as F

from tidemark.operators import footers, monitor, quality
from tidemark.operators.tables import Table

SF = "/root/testdata/sf0.001"


def scanned(df):
    """Rows that the Parquet scan of a plan gave, by its own count."""
    df.collect()
    found, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        plan = todo.pop()
        if plan.nodeName() == "AdaptiveSparkPlan":
            plan = plan.executedPlan()
        if "Scan parquet" in plan.nodeName():
            found.append(plan.metrics().apply("numOutputRows").value())
        children = plan.children()
        todo += [children.apply(k) for k in range(children.size())]
    return sum(found)


def test_one_loan_is_found_by_range_and_by_bloom_filter(spark, tmp_path):
    rows = spark.range(60_000).select((F.col("id") * 2).alias("loan_id"), F.sha2(F.col("id").cast("string"), 512).alias("note"))
    spark.conf.set("parquet.block.size", 400_000)
    spark._jsc.hadoopConfiguration().setInt("parquet.block.size", 400_000)
    try:
        ordered, mixed = Table(spark, str(tmp_path / "ordered")), Table(spark, str(tmp_path / "mixed"))
        ordered.replace(rows, sort=["loan_id"], bloom="loan_id", files=2)
        mixed.replace(rows.repartition(2).sortWithinPartitions(F.xxhash64("loan_id")), bloom="loan_id")
    finally:
        spark.conf.unset("parquet.block.size")
        spark._jsc.hadoopConfiguration().unset("parquet.block.size")
    groups = {n: footers.skipped(t.read(), "loan_id", 2 * 12_345).collect() for n, t in (("ordered", ordered), ("mixed", mixed))}
    assert all(len(g) >= 8 and sum(r.rows for r in g) == 60_000 and all(r.bloom for r in g) for g in groups.values())
    assert sum(not r.by_range for r in groups["ordered"]) == 2 and not any(r.by_range for r in groups["mixed"])
    assert not any(r.bloom for r in footers.skipped(ordered.read(), "note", "x").collect())
    assert sum(r.rows for r in groups["ordered"] if not r.by_range) >= scanned(ordered.read().where("loan_id = 24690"))
    one = mixed.read().where("loan_id = 24690")
    assert one.count() == 1 and scanned(one) < max(r.rows for r in groups["mixed"]) + 1  # of the group that holds it alone
    assert scanned(mixed.read().where("loan_id = 24691")) < 60_000 / 2  # nowhere: the filters tell, not the ranges


def test_statistics_are_those_of_the_footers(spark, tmp_path):
    spark.range(1000).select("id", F.lit("same").alias("x")).repartition(3).write.parquet(str(tmp_path / "t"))
    spark.range(0).write.parquet(str(tmp_path / "none"))
    tables = {"t": spark.read.parquet(str(tmp_path / "t")), "none": spark.read.parquet(str(tmp_path / "none")), "lineitem": spark.read.parquet(f"{SF}/lineitem.parquet")}
    got = {r.table_name: r for r in footers.statistics(tables).collect()}
    for name, files in (("t", str(tmp_path / "t/*.parquet")), ("lineitem", f"{SF}/lineitem.parquet")):
        want = duckdb.sql(f"select count(distinct file_name), sum(total_uncompressed_size) / sum(total_compressed_size), sum(row_group_num_rows) filter (column_id = 0) from parquet_metadata('{files}')").fetchall()[0]
        assert got[name].files == want[0] and abs(got[name].compression_ratio - want[1]) < 1e-4 and got[name].rows == want[2]
    assert got["none"].rows == 0 and got["none"].files == 1


def test_a_check_that_fails_alone(spark):
    df = spark.createDataFrame([("1",), ("x",)], "v string")
    got = {r.check_name: r for r in quality.gate_of([(df, [("n", F.count("*"), "==", 2, True), ("bad", F.sum(F.col("v").cast("int")), ">", 0, True), ("two", F.max("v"), ">", 0, False)]), (df, [("again", F.count("v"), ">=", 2, True)])]).collect()}
    assert got["n"].passed and got["n"].value == 2 and got["again"].passed and got["again"].error is None
    assert not got["bad"].passed and got["bad"].value is None and "CAST_INVALID_INPUT" in got["bad"].error


def test_histories_keep_so_many_days(spark, tmp_path):
    schema = "invocation_id string, run_id string, executed_at timestamp, node_id string, status string, execution_time double, failures int, materialization string, rows_affected long, message string"
    run = lambda day, node: (f"i{day}", "r", dt.datetime(2026, 1, day), node, "pass", 1.0, 0, None, 1, None)
    tests, models = Table(spark, str(tmp_path / "tests"), "day"), Table(spark, str(tmp_path / "models"), "day")
    for day in (1, 5, 20):
        quality.keep_results(spark.createDataFrame([run(day, "test.p.t"), run(day, "model.p.stg_m")], schema), tests, models, dt.datetime(2026, 1, day), 10)
    assert sorted(r.executed_at.day for r in tests.read().collect()) == [20] and models.read().first().model_name == "stg_m"


def test_totals_of_rejects_by_entity(spark):
    at = dt.datetime(2026, 1, 2)
    rows = [("a", "r1", at), ("a", "r1", at - dt.timedelta(hours=1)), ("a", "r2", at), ("b", None, at), ("b", "r", at - dt.timedelta(days=2))]
    got = monitor.reject_totals(spark.createDataFrame(rows, "entity string, rule string, rejected_at timestamp"), at).collect()
    assert [(r.entity, r.rejects, r.rules) for r in got] == [("a", 3, 2), ("b", 1, 0)]
