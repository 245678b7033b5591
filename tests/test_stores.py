"""Registry snapshots (versioned, last write wins) and multi-layout CSV reads."""

import time

from telemetry_engine.sources.csv_metrics import good_rows, read_metrics_csv
from telemetry_engine.sources.store import read_registry, upsert_registry
from telemetry_engine.streaming.pipeline import ObservedMetricsReporter

DEV = "uuid string, device_id string, gpu_index string, model_name string, hostname string, container string, pod string, namespace string, seq long"


def test_registry_versions_and_upserts(spark, tmp):
    base = f"{tmp}/registry"
    assert read_registry(spark, base) is None
    v1 = upsert_registry(spark, spark.createDataFrame([("u1", "n0", "0", "H100", "h1", "c", "", "", 1)], DEV), base)
    v2 = upsert_registry(spark, spark.createDataFrame([("u1", "n0", "0", "H100", "h1", "", "p", "", 2),
                                                       ("u2", "n1", "1", "A100", "h2", "", "", "", 1)], DEV), base)
    assert (v1, v2) == (1, 2)
    reg = {r.uuid: r for r in read_registry(spark, base).collect()}
    assert set(reg) == {"u1", "u2"} and (reg["u1"].container, reg["u1"].pod) == ("", "p")
    # an interrupted write (no _SUCCESS) is invisible and gets replaced
    import os

    os.makedirs(f"{base}/v=00000003")
    assert read_registry(spark, base).count() == 2


def test_files_with_different_header_layouts(spark, tmp):
    a = f"{tmp}/a.csv"
    b = f"{tmp}/b.csv"
    with open(a, "w") as f:
        f.write("timestamp,metric_name,gpu_id,device,uuid,modelName,Hostname,value\nt,m,0,n0,GPU-1,H,h,1\n")
    with open(b, "w") as f:
        f.write("value,uuid,metric_name,Hostname,modelName,device,gpu_id,timestamp,pod\n2,GPU-2,m,h,H,n1,1,t,p9\n")
    rows = sorted((r.uuid, r.value, r.pod, r.device) for r in good_rows(read_metrics_csv(spark, [a, b])).collect())
    assert rows == [("GPU-1", "1", "", "n0"), ("GPU-2", "2", "p9", "n1")]


def test_progress_listener_accumulates(spark, tmp):
    rep = ObservedMetricsReporter("m")
    spark.streams.addListener(rep)
    try:
        from pyspark.sql import functions as F

        spark.range(10).write.parquet(f"{tmp}/src")
        src = spark.readStream.schema("id long").parquet(f"{tmp}/src")
        obs = src.observe("m", F.count(F.lit(1)).alias("rows"))
        q = obs.writeStream.format("noop").option("checkpointLocation", f"{tmp}/ck").trigger(availableNow=True).start()
        q.awaitTermination()
        deadline = time.time() + 30
        while not rep.totals and time.time() < deadline:
            time.sleep(0.5)  # listener events arrive asynchronously
        assert sum(t.get("rows", 0) for t in rep.totals.values()) == 10
    finally:
        spark.streams.removeListener(rep)


def test_directory_with_mixed_header_layouts(spark, tmp):
    import os


    d = f"{tmp}/mixed"
    os.makedirs(d)
    layouts = {
        "a.csv": "timestamp,metric_name,gpu_id,device,uuid,modelName,Hostname,value\nt,m,0,n0,GPU-1,H,h,1\n",
        "b.csv": "value,uuid,metric_name,Hostname,modelName,device,gpu_id,timestamp\n2,GPU-2,m,h,H,n1,1,t\n",
        "c.csv": "timestamp,metric_name,gpu_id,device,uuid,modelName,Hostname,value\nt,m,0,n3,GPU-3,H,h,3\n",
        "empty.csv": "",
        "_SUCCESS": "",
    }
    for name, text in layouts.items():
        with open(f"{d}/{name}", "w") as f:
            f.write(text)
    rows = sorted((r.uuid, r.value, r.device) for r in good_rows(read_metrics_csv(spark, d)).collect())
    assert rows == [("GPU-1", "1", "n0"), ("GPU-2", "2", "n1"), ("GPU-3", "3", "n3")]
