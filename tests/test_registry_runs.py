"""The registry as runs: equal to the latest row per device, small writes, replay, upkeep."""

import os
import random

import pytest

from telemetry_engine.schemas import DEVICE_COLUMNS
from telemetry_engine.sources import fs
from telemetry_engine.streaming import registry_runs as rr
from telemetry_engine.streaming.epochs import commit, epoch_dir

REST = ["", "0", "m", "h", "c", "p", "n"]


def _rows(spark, rows):
    """(uuid, device_id, ord) -> devices."""
    return spark.createDataFrame([(u, d, *REST[1:], o) for u, d, o in rows], rr.SCHEMA).coalesce(1)


def _add(spark, out, epoch, rows, per_level=2, done=True):
    rr.add_run(spark, f"{out}/registry", epoch, _rows(spark, rows), per_level)
    if done:
        commit(spark, out, epoch)


def _registry(spark, out):
    return sorted((r.uuid, r.device_id) for r in rr.read_runs(spark, f"{out}/registry").collect())


def _files(path):
    return {os.path.relpath(os.path.join(d, f), path): os.path.getsize(os.path.join(d, f))
            for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_runs_of_a_level_are_merged_like_digits_that_carry():
    live, written, levels = [], [], 4
    for e in range(3 ** levels):
        kept, merged, level = rr.plan_run(live, 3)
        assert kept + merged == live
        written.append(1 + sum(3 ** x for _, x in merged))
        live = [*kept, (e, level)]
        assert all(sum(x == y for _, y in live) < 3 for x in range(levels + 1))
    assert live == [(3 ** levels - 1, levels)]
    assert sum(written) == 3 ** levels + levels * 2 * 3 ** (levels - 1)  # two thirds of the rows again a level


def test_registry_equals_the_latest_rows_in_any_order_of_epochs(spark, tmp):
    rng = random.Random(3)
    rows = [(f"u{rng.randint(0, 9)}", f"d{k}", k) for k in range(70)]
    rng.shuffle(rows)
    parts = [rows[k::7] for k in range(7)]
    parts[4] = []  # an epoch without devices
    for e, part in enumerate(parts):
        _add(spark, tmp, e, part)
        seen = [r for p in parts[:e + 1] for r in p]
        best = {u: max(o for x, _, o in seen if x == u) for u, _, _ in seen}
        assert _registry(spark, tmp) == sorted((u, f"d{o}") for u, o in best.items())
    assert [x for _, x in rr.live_runs(spark, f"{tmp}/registry")] == [2, 1, 0]


def test_null_and_tied_orders_have_one_winner_in_any_grouping(spark, tmp):
    parts = [[("u", "a", None), ("v", "x", 1)], [("u", "b", 0), ("v", "y", 1)], [("u", "c", None), ("v", "w", 1)], [(None, "z", 1)]]
    for name, order in (("one", [0, 1, 2, 3]), ("two", [3, 2, 1, 0])):
        for e, k in enumerate(order):
            _add(spark, f"{tmp}/{name}", e, parts[k], per_level=2 + (name == "two"))
    key = lambda r: (str(r[0]), r[1])
    got = [sorted(map(tuple, rr.read_runs(spark, f"{tmp}/{n}/registry").select("uuid", "device_id").collect()), key=key) for n in ("one", "two")]
    assert got[0] == got[1] == [(None, "z"), ("u", "b"), ("v", "y")]


def test_an_epoch_writes_its_updates_and_not_the_registry(spark, tmp):
    _add(spark, tmp, 0, [(f"u{k:05d}", f"d{k}", 0) for k in range(20_000)], per_level=8)
    for e in range(1, 7):
        _add(spark, tmp, e, [(f"u{e:05d}", "new", e)], per_level=8)
    base = f"{tmp}/registry"
    size = {e: sum(_files(epoch_dir(base, e)).values()) for e in range(7)}
    assert all(size[e] * 20 < size[0] for e in range(1, 7))
    assert [spark.read.parquet(epoch_dir(base, e)).count() for e in range(7)] == [20_000] + [1] * 6
    assert len(_registry(spark, tmp)) == 20_000 and _registry(spark, tmp)[3] == ("u00003", "new")


def test_replay_of_an_epoch_changes_nothing(spark, tmp):
    for e in range(3):
        _add(spark, tmp, e, [("u", f"d{e}", e), (f"u{e}", "x", e)])
    before = _registry(spark, tmp)
    base = f"{tmp}/registry"
    _add(spark, tmp, 3, [("u", "d3", 3)], done=False)            # merges all runs; not committed
    assert _registry(spark, tmp) == before
    rr.remove_merged(spark, base, rr.live_runs(spark, base, before=3), 3, hours=-1)
    _add(spark, tmp, 3, [("u", "d3", 3)])
    once, runs = _registry(spark, tmp), rr.live_runs(spark, base)
    _add(spark, tmp, 3, [("u", "d3", 3)])
    assert _registry(spark, tmp) == once == [("u", "d3"), ("u0", "x"), ("u1", "x"), ("u2", "x")]
    assert rr.live_runs(spark, base) == runs == [(3, 2)]


def test_a_run_without_its_list_is_not_part_of_the_registry(spark, tmp):
    _add(spark, tmp, 0, [("u", "d0", 0)])
    _add(spark, tmp, 1, [("u", "d1", 1)])
    fs.delete(spark, f"{epoch_dir(f'{tmp}/registry', 1)}/_runs")
    assert _registry(spark, tmp) == [("u", "d0")]
    _add(spark, tmp, 2, [("v", "d2", 2)])
    assert _registry(spark, tmp) == [("u", "d0"), ("v", "d2")]


def test_merged_runs_go_after_a_while_and_live_ones_stay(spark, tmp):
    base = f"{tmp}/registry"
    for e in range(6):
        _add(spark, tmp, e, [(f"u{e}", "x", e)])
    live = rr.live_runs(spark, base)
    assert [e for e, _ in live] == [3, 5] and len(fs.list_subdirs(spark, base)) == 7  # six runs and the notes
    rr.remove_merged(spark, base, live, 6)                        # too early
    assert len(fs.list_subdirs(spark, base)) == 7
    rr.remove_merged(spark, base, live, 6, hours=-1)
    assert fs.list_subdirs(spark, base) == ["_merged", "epoch=0000000003", "epoch=0000000005"]
    assert [u for u, _ in _registry(spark, tmp)] == [f"u{e}" for e in range(6)]


def test_a_lookup_reaches_the_scan_of_every_run(spark, tmp):
    for e in range(3):
        _add(spark, tmp, e, [(f"u{e}", "x", e)], per_level=8)
    found = rr.read_runs(spark, f"{tmp}/registry").where("uuid = 'u1'")
    plan = found._jdf.queryExecution().toString()
    assert "EqualTo(uuid,u1)" in plan
    assert [r.uuid for r in found.collect()] == ["u1"]


def test_no_run_is_an_empty_registry_and_one_run_a_level_is_refused(spark, tmp):
    got = rr.read_runs(spark, f"{tmp}/registry")
    assert got.columns == DEVICE_COLUMNS and got.count() == 0
    with pytest.raises(ValueError):
        _add(spark, tmp, 0, [("u", "d", 0)], per_level=1)
