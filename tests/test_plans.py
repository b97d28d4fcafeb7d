"""Physical plans keep the properties the design relies on at scale."""

import re

from conftest import SF_SMALL
from pitlane.plans.queries import QUERIES


def final_plan(df) -> str:
    df.collect()  # runs this DataFrame's own adaptive plan to its final form
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "AdaptiveSparkPlan" not in plan or "isFinalPlan=true" in plan
    # an adaptive plan prints its final form first, then the initial one
    return plan.split("== Initial Plan ==")[0]


def test_pipeline_one_row_shuffle_and_hash_aggregates(spark):
    plan = final_plan(QUERIES["prepare_full"](spark, SF_SMALL))
    assert "SortAggregate" not in plan
    assert "rangepartitioning" not in plan  # no global sort
    # rows are scanned once and the block summary once more; its exchange is reused
    assert len(re.findall(r"FileScan parquet", plan)) == 2
    assert "ReusedExchange" in plan
    # the rows are exchanged once, on (series, block) of the first level
    row_exchanges = [
        l for l in plan.splitlines() if "Exchange hashpartitioning(_pl0_series" in l and "ReusedExchange" not in l
    ]
    assert len(row_exchanges) == 2  # the rows, and the partial block summaries


def test_clean_does_not_shuffle(spark):
    plan = final_plan(QUERIES["clean_full"](spark, SF_SMALL))
    assert "Exchange" not in plan and "Sort" not in plan


def test_profiles_aggregate_partially(spark):
    plan = final_plan(QUERIES["group_count"](spark, SF_SMALL))
    assert "partial_count" in plan


def test_scans_read_only_needed_columns(spark):
    plan = final_plan(QUERIES["group_count_orders"](spark, SF_SMALL))
    assert "ReadSchema: struct<o_orderstatus:string>" in plan
    plan = final_plan(QUERIES["presence_flags"](spark, SF_SMALL))
    assert "value" not in re.search(r"ReadSchema: struct<[^>]*>", plan).group(0)


def test_hot_series_is_split_across_tasks(spark):
    from pyspark.sql import functions as F

    from pitlane.operators.impute import prepare
    from pitlane.operators.series import Series
    from pitlane.plans.telemetry_view import load_t

    # every row in one series: a plain window would put all of it in one task
    t = load_t(spark, SF_SMALL).withColumn("raceId", F.lit("hot")).withColumn("pilot_index", F.lit(0))
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        def largest_share(series):
            out = prepare(t, series=series).withColumn("task", F.spark_partition_id())
            # count a column the pass computes, so the optimizer keeps the pass
            sizes = [r[1] for r in out.groupBy("task").agg(F.count("row_num")).collect()]
            return max(sizes) / sum(sizes)

        assert largest_share(Series(levels=0)) == 1.0
        assert largest_share(Series(block_frames=64, fan_out=4)) < 0.4
    finally:
        spark.conf.set(key, before)


def test_cleaning_is_one_codegen_span(spark):
    plan = final_plan(QUERIES["clean_full"](spark, SF_SMALL))
    ops = [l.strip(" +-:") for l in plan.splitlines() if l.strip()]
    assert ops[-1].startswith("FileScan parquet") and "Batched: true" in ops[-1]
    assert all(op.startswith("*(1) ") for op in ops[:-1]), ops


def test_the_csv_is_parsed_once(spark, workdir):
    from pitlane.plans.fixtures import write_kind
    from pitlane.plans.pipeline import PipelineConf, cleaned_telemetry, prepared_telemetry
    from pitlane.plans.telemetry_view import load_t

    root = f"{workdir}/races"
    write_kind(load_t(spark, SF_SMALL), root, "Telemetry", mode="overwrite")
    conf = PipelineConf(source=root)
    cleaned = cleaned_telemetry(spark, conf)
    assert len(re.findall("FileScan csv", final_plan(cleaned))) == 1
    cleaned.write.parquet(f"{workdir}/cleaned")
    staged = spark.read.schema(cleaned.schema).parquet(f"{workdir}/cleaned")
    assert "FileScan csv" not in final_plan(prepared_telemetry(staged, conf))


def test_global_sort_orders_the_rows(spark):
    from pyspark.sql import functions as F

    from pitlane.operators.series import ordered
    from pitlane.plans.telemetry_view import load_t

    # the row index is added after the sort, so it follows the partitions' order
    rows = ordered(load_t(spark, SF_SMALL)).withColumn("i", F.monotonically_increasing_id()).collect()
    keys = [(r.raceId, r.pilot_index, r.frameIdentifier) for r in sorted(rows, key=lambda r: r.i)]
    assert keys == sorted(keys) and len(keys) == load_t(spark, SF_SMALL).count()


def test_profiles_of_dotted_columns(spark):
    from pitlane.operators import profile as P

    df = spark.createDataFrame([(1, None), (2, 3), (2, None)], "`k.x` int, `a.b` int")
    assert P.null_counts(df, by=["k.x"]).orderBy("`k.x`").collect()[1]["a.b"] == 1
    assert P.null_shares(df).first()["rows"] == 3
    assert sorted((r["column"], r["nulls"]) for r in P.profile(df).collect()) == [("a.b", 2), ("k.x", 0)]
    assert P.value_counts(df, "k.x").count() == P.distinct_values(df, "k.x").count() == 2
    assert P.null_rows(df, "a.b").count() == 2 and P.duplicate_keys(df, ["k.x"]).count() == 1
