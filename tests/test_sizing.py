"""Broadcast only behind a size check, with a shuffle join beyond it."""

from cohortwise.plans.sizing import shared_dir, small_side


def _plan(spark, small, big):
    return big.join(small, "k")._jdf.queryExecution().executedPlan().toString()


def test_small_side_broadcasts_only_within_bound(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    old_aqe = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # no size-based broadcast by Spark itself
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        big = spark.range(1000).withColumnRenamed("id", "k")
        lookup = spark.range(11).withColumnRenamed("id", "k")
        assert "BroadcastHashJoin" in _plan(spark, small_side(lookup, max_rows=20), big)
        plan = _plan(spark, small_side(lookup, max_rows=10), big)
        assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.set("spark.sql.adaptive.enabled", old_aqe)


def test_shared_dir_is_under_checkpoint_folder(spark):
    a, b = shared_dir(spark, "x"), shared_dir(spark, "x")
    assert a != b
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert a.startswith(base)
