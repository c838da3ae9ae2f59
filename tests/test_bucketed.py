"""C8 over co-bucketed tables: same rows, no exchange."""

from silverline.operators.cdc import current_resources
from silverline.session import scratch_dir
from silverline.sources.bucketed import bucketed_session, current_of_buckets, store_bucketed
from silverline.sources.fixtures import derive_bronze


def test_no_body_moves_and_rows_are_the_same(spark):
    bronze = derive_bronze(spark, "/root/testdata/sf0.001")
    store_bucketed(bronze, "bucketed_test", scratch_dir(spark, "bucketed"), 8)
    got = current_of_buckets(bucketed_session(spark), "bucketed_test")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan and "SelectedBucketsCount" in plan
    want = current_resources(bronze.hfj_resource, bronze.hfj_res_ver)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    final = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in final
    spark.sql("DROP DATABASE bucketed_test CASCADE")
