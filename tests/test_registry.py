"""Registry: last write wins (blank overwrites), listing, existence sets."""

from telemetry_engine.operators import registry as R

DEV = "uuid string, device_id string, gpu_index string, model_name string, hostname string, container string, pod string, namespace string"


def test_upsert_last_write_wins_and_blank_overwrites(spark):
    cur = spark.createDataFrame([("u1", "nvidia0", "0", "H100", "h1", "c", "p", "ns"),
                                 ("u2", "nvidia1", "1", "A100", "h2", "", "", "")], DEV)
    upd = spark.createDataFrame([("u1", "nvidia0", "0", "H100", "h1", "c2", "p2", "ns", 1),
                                 ("u1", "nvidia0", "0", "H100", "h1", "", "p3", "ns", 2),
                                 ("u3", "nvidia2", "2", "L4", "h3", "", "", "", 1)], DEV + ", seq long")
    out = {r.uuid: r for r in R.upsert_devices(cur, upd).collect()}
    assert set(out) == {"u1", "u2", "u3"}
    assert (out["u1"].container, out["u1"].pod) == ("", "p3")
    assert out["u2"].model_name == "A100"


def test_semi_anti_and_counts(spark):
    devs = spark.createDataFrame([("u1",) + ("",) * 7, ("u2",) + ("",) * 7], DEV)
    tel = spark.createDataFrame([("u1",), ("u1",), ("u9",)], "gpu_uuid string")
    assert [r.uuid for r in R.devices_with_telemetry(devs, tel).collect()] == ["u1"]
    assert [r.uuid for r in R.unknown_devices(tel, devs, column="gpu_uuid").collect()] == ["u9"]
    assert {r.store: r.n for r in R.counts(tel, devs).collect()} == {"telemetry": 3, "devices": 2}
    assert R.get_device(devs, "u2").count() == 1 and R.get_device(devs, "zz").count() == 0
