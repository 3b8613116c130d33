"""What the physical plans must and must not contain."""

from types import SimpleNamespace

import pytest

from dunlin.plans import QUERIES
from dunlin.session import shared_dir

SF_DIR = "/root/testdata/sf0.001"
CHEAP = [
    "feature_table", "filter_and", "join_inner", "eps_range_join", "group_sum_many", "top_k_per_group", "tfidf",
    "standard_scale", "train_per_group", "infer_per_group", "multiclass_report", "davies_bouldin", "pivot_mean",
    "row_number_index", "ordinal_encode", "knn_classify", "similar_items",
]


def plan(spark, name):
    return QUERIES[name](spark, SF_DIR)._jdf.queryExecution().toString()


@pytest.mark.parametrize("name", CHEAP)
def test_no_cross_join(spark, name):
    text = plan(spark, name)
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_filters_and_columns_reach_the_scan(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    text = plan(spark, "filter_and")
    assert "EqualTo(l_returnflag,R)" in text and "GreaterThan(l_quantity,30.0)" in text
    assert "l_extendedprice" not in text.split("ReadSchema")[1].split("\n")[0]


def test_top_k_is_cut_before_the_shuffle(spark):
    text = plan(spark, "top_k_per_group").split("== Physical Plan ==")[1]
    assert text.count("WindowGroupLimit") >= 2


def test_shared_folder_comes_from_the_session(spark):
    named = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: f"/shared/{key}/"))
    assert shared_dir(named) == "/shared/spark.checkpoint.dir"
    assert shared_dir(spark) == shared_dir(spark)
