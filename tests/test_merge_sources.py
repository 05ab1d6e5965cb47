from pyspark.sql import functions as F

from merchpulse.operators.merge import cogroup_frames, first_or_default
from merchpulse.plans.job import score_all
from merchpulse.schema import METRIC_LONG
from merchpulse.sources.metrics import merchant_scan, metric_scan, project, read_jdbc

from tests.fixture import AS_OF, EXPECTED_FINAL, ROWS


def test_cogroup_counts_and_first(spark):
    a = spark.createDataFrame([("k1", 1.0), ("k1", 2.0), ("k2", 3.0)], "k string, value double")
    b = spark.createDataFrame([("k3", "x")], "k string, value string")
    c = spark.createDataFrame([("k1", 7)], "k string, value bigint")
    got = {r.k: r for r in cogroup_frames([a, b, c], "k", names=["a", "b", "c"], counts=True).collect()}
    assert set(got) == {"k1", "k2", "k3"}
    assert (got["k1"].a, got["k1"].a_count, got["k1"].b, got["k1"].b_count, got["k1"].c) == (1.0, 2, None, 0, 7)
    assert (got["k3"].b, got["k3"].b_count) == ("x", 1)


def test_first_or_default(spark):
    df = spark.createDataFrame([("k", "201502", 5), ("k", "201501", 9), ("j", None, None)], "k string, m string, v int")
    got = dict(df.groupBy("k").agg(first_or_default(F.col("v"), -1, order=F.col("m")).alias("f")).collect())
    assert got == {"k": 9, "j": -1}


def test_jdbc_source_in_process(spark):
    """An embedded Derby database in the driver JVM: no server, no port."""
    url = "jdbc:derby:memory:merchpulse_metrics;create=true"
    driver = "org.apache.derby.jdbc.EmbeddedDriver"
    (spark.createDataFrame(ROWS, METRIC_LONG).write.format("jdbc").mode("overwrite")
     .option("url", url).option("dbtable", "METRICS").option("driver", driver)
     .option("createTableColumnTypes",
             "property_uuid VARCHAR(64), target_time VARCHAR(8), metric_dim_code VARCHAR(32), "
             "metric_value VARCHAR(32)")
     .save())
    src = read_jdbc(spark, url, "METRICS", driver=driver,
                    predicates=['"property_uuid" < \'E\'', '"property_uuid" >= \'E\''])
    assert src.rdd.getNumPartitions() == 2
    metrics = metric_scan(src)
    assert metrics.count() == len([r for r in ROWS if r[2] != "M_OTHER"])
    one = merchant_scan(src, "A")
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        assert "EqualTo(property_uuid,A)" in one._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    final = {r.property_uuid: r.final_score for r in score_all(metrics, AS_OF).final.collect()}
    assert final == EXPECTED_FINAL
    sub = read_jdbc(spark, url, '(SELECT "property_uuid", "metric_value" FROM METRICS) t', driver=driver)
    assert project(sub, "property_uuid", "property_uuid = 'C'").count() == 3
