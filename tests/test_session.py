"""Session helpers: sizing and one-time materialisation."""

from pyspark.sql import functions as F

from telemetry_engine.session import materialize, scale_conf, shared_dir


def test_scale_conf_sizes_from_shuffle_bytes():
    small = scale_conf(10 << 20)
    big = scale_conf(10 << 40)
    assert small["spark.sql.shuffle.partitions"] == "200"          # floor
    assert big["spark.sql.shuffle.partitions"] == str((10 << 40) // (256 << 20))


def test_streams_keep_their_state_in_rocksdb(spark):
    assert "RocksDB" in spark.conf.get("spark.sql.streaming.stateStore.providerClass")


def test_materialize_computes_once_and_cuts_lineage(spark):
    assert shared_dir(spark)
    acc = spark.sparkContext.accumulator(0)
    df = spark.range(100).withColumn("x", F.col("id") * 2)
    m = materialize(df)
    plan = m._jdf.queryExecution().optimizedPlan().toString()
    assert "Range" not in plan            # reads the checkpoint, not the source plan
    m.foreach(lambda r: acc.add(1))
    m.foreach(lambda r: acc.add(1))
    assert acc.value == 200 and m.count() == 100
