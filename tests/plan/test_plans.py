"""Physical-plan shape: the properties that make the queries scale."""

from screenrank.operators import content, stats
from screenrank.plans.catalogue import QUERIES
from screenrank.sources import fixtures as fx
from tests.conftest import SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString() + \
        df._jdf.queryExecution().optimizedPlan().toString()


def formatted(df) -> str:
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted") \
        if hasattr(df._sc._jvm, "PythonSQLUtils") else plan(df)


def test_statistics_plans_have_no_python(spark):
    for name in ["rating_count", "rating_count_by_month", "rating_avg", "genre_top10", "item_tags",
                 "search_documents", "recent_ratings", "stream_scores", "content_similar"]:
        p = plan(QUERIES[name](spark, SF_SMALL))
        assert "PythonUDF" not in p and "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name


def test_top_k_uses_window_group_limit(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        p = plan(QUERIES["genre_top10"](spark, SF_SMALL))
        assert "WindowGroupLimit" in p
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_sparse_similarity_has_no_cartesian(spark):
    p = plan(content.content_similar(fx.part_movies(spark, SF_SMALL)))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_scans_are_pruned(spark):
    df = stats.rating_avg(fx.star_ratings(spark, SF_SMALL))
    p = df._jdf.queryExecution().executedPlan().toString()
    # only the needed lineitem / orders columns are read
    assert "l_extendedprice" not in p and "o_totalprice" not in p
    ev = QUERIES["recent_ratings"](spark, SF_SMALL)
    assert "value" not in ev._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[-1][:200]


def test_no_nested_loop_or_cartesian_join_anywhere(spark):
    for name, fn in QUERIES.items():
        if name in ("stream_recs", "als_grid", "als_user_recs", "als_item_similar"):
            continue  # these run jobs while building; covered by unit tests
        p = plan(fn(spark, SF_SMALL))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name
