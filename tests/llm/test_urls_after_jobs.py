"""Models score in a session that has observed a query before, as the table jobs do."""

from __future__ import annotations

from pyspark.sql import Observation
from pyspark.sql import functions as F

from sluice.llm import queries

SF = "/root/testdata/sf0.001"


def test_url_filter_after_an_observation(spark):
    seen = Observation("rows")
    spark.range(10).observe(seen, F.count(F.lit(1)).alias("n")).write.format("noop").mode("overwrite").save()
    assert seen.get["n"] == 10
    queries.QUERIES["op10_url_filter"](spark, SF).write.format("noop").mode("overwrite").save()
