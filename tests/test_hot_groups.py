"""A group that holds most rows must not be gathered: the large side of group joins is not shuffled."""

import re

import pytest
from pyspark.sql import functions as F

from lodestat.operators import simplex, summaries


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("skewed") / "t")
    spark.range(3000).select(F.when(F.col("id") % 3 < 2, "hot").otherwise("cold").alias("g"), (F.col("id") % 97).cast("double").alias("x")).write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("make", [lambda d: summaries.outliers(d, "x", "g"), lambda d: simplex.project_simplex(d, "x", ["g"], 3.0)])
def test_rows_stay_where_they_are(skewed, make):
    out = make(skewed)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and not re.search(r"SortMergeJoin|Exchange hashpartitioning", plan)
    assert out.count() >= 0
