"""Shapes of the physical plans that large tables depend on."""

from pyspark.sql import functions as F

from flowvec import plans
from flowvec.operators import analytics as A
from flowvec.operators import knn as K
from flowvec.operators import positions as P
from flowvec.sources.tables import Tables


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_batch_search_limits_before_the_shuffle(spark, folder):
    text = plan(plans.queries()["knn_join"](spark, folder))
    assert "WindowGroupLimit" in text and text.index("Final") < text.index("Partial")
    assert text.count("Exchange hashpartitioning") == 1


def test_single_search_is_a_bounded_sort_over_two_columns(spark, folder):
    rows = Tables(spark, folder).embeddings
    text = plan(K.knn(rows, [0.1] * 64, 5, "l2", "vec_id"))
    assert "TakeOrderedAndProject" in text and "Exchange" not in text
    assert "label" not in text.split("ReadSchema")[1]


def test_payload_filter_reaches_the_scan(spark, folder):
    rows = Tables(spark, folder).embeddings
    hits = K.knn(rows, [0.1] * 64, 3, "l2", "vec_id")
    text = plan(K.report(hits, rows, "vec_id", "label"))
    assert "PushedFilters: [In(vec_id" in text
    assert "ReadSchema: struct<vec_id:bigint,label:int>" in text


def test_filters_and_columns_are_pushed_down(spark, folder):
    flows = Tables(spark, folder).events.where(F.col("value") > 90).select("event_id")
    text = plan(flows)
    assert "GreaterThan(value,90.0)" in text and "ReadSchema: struct<event_id:bigint,value:double>" in text


def test_positions_need_no_single_partition(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    text = plan(P.with_position(df, "k", rows_per_bucket=100))
    windows = [line for line in text.splitlines() if "row_number" in line]
    assert windows and all("_bucket" in line for line in windows if "Window" in line)


def test_deduplication_combines_before_the_shuffle(spark, folder):
    flows = Tables(spark, folder).flows
    text = plan(A.keep_first(flows, ["ip_src", "ip_dst", "protocol"], "frame_number"))
    assert text.count("partial_min_by") >= 1 and text.count("Exchange") == 1
