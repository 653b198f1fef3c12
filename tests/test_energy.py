import math
import random

import pytest
from pyspark.sql import functions as F

from quern.operators import energy, ordered
from quern.plans.energy_report import energy_report


def steps(high, low, spacing=1 / 60):
    p = [3.0 + 0.1 * i / max(high - 1, 1) for i in range(high)] + [0.55 - 0.05 * i / max(low - 1, 1) for i in range(low)]
    return p, [i * spacing for i in range(high + low)]


def percentile(values, q):
    v = sorted(values)
    pos = (len(v) - 1) * q
    i = math.floor(pos)
    a, b, t = v[i], v[min(i + 1, len(v) - 1)], pos - i
    return a + (b - a) * t if t < 0.5 else b - (b - a) * (1 - t)


def restated_cutoff(p, t):
    """The backward scan as a loop, written from its description."""
    n = len(p)
    if n < 30:
        return None
    threshold = percentile(p, 0.4)
    w = min(5, n // 10)
    left = w // 2
    smooth = list(p)
    for i in range(n):
        window = p[max(i - left, 0) : i - left + w] if i - left >= 0 else []
        if len(window) == w:
            smooth[i] = p[i] if min(window) == max(window) else sum(window) / w
    tail = min(20, n // 3)
    if sum(smooth[-tail:]) / tail > threshold:
        return None
    cutoff, low = None, 0
    for i in range(n - 1, 20, -1):
        if smooth[i] < threshold:
            low += 1
        else:
            if low >= 5:
                cutoff = i + 1
                break
            low = 0
    if cutoff is None and low >= 5:
        cutoff = 20
    if cutoff is None or cutoff >= n - 1 or (t[-1] - t[cutoff]) * 60 < 3:
        return None
    return cutoff


def made_runs():
    runs = {
        "n29": steps(18, 11),
        "n30": steps(18, 12),
        "cut60": steps(60, 40),
        "cut58": steps(60, 20),
        "short": steps(60, 40, 4 / 3600),
        "back": steps(21, 13),
        "flat": ([0.7] * 60, [i / 60 for i in range(60)]),
    }
    for n in (39, 40, 49, 50):
        runs[f"w{n}"] = steps(n - n // 3, n // 3)
    rng = random.Random(11)
    for k in range(40):
        n = rng.randrange(30, 120)
        cut = rng.randrange(20, n)
        p = [round(rng.uniform(1, 2) if i < cut else rng.uniform(0.5, 1.3), 3) for i in range(n)]
        runs[f"r{k}"] = (p, [i / 30 for i in range(n)])
    return runs


def table(spark, runs):
    data = [(run, i * 2, pw, t) for run, (p, ts) in runs.items() for i, (pw, t) in enumerate(zip(p, ts))]
    return spark.createDataFrame(data, "run_id string, sample_index long, power_kw double, runtime_hours double")


@pytest.mark.parametrize("blocked", [False, True])
def test_cutoffs_match_the_scan(spark, monkeypatch, blocked):
    if blocked:
        monkeypatch.setattr(ordered, "BLOCK_BITS", 4)
        monkeypatch.setattr(energy, "BLOCK_BITS", 4)
    runs = made_runs()
    indexed = energy.index_samples(table(spark, runs), blocked=blocked)
    got = {r.run_id: r.cutoff for r in energy.locate_tail(indexed, blocked=blocked).collect()}
    want = {run: restated_cutoff(p, t) for run, (p, t) in runs.items()}
    assert got == want
    assert (want["cut60"], want["cut58"], want["back"]) == (60, 58, 20)
    assert want["n29"] is want["short"] is want["flat"] is None
    assert sum(c is not None for c in want.values()) > 10

    kept = energy.exclude_tail(indexed, blocked=blocked).groupBy("run_id").count().collect()
    assert {r.run_id: r["count"] for r in kept} == {r: want[r] if want[r] is not None else len(p) for r, (p, _) in runs.items()}


def test_blocked_and_whole_runs_give_the_same_report(spark, monkeypatch):
    runs = made_runs()
    data = [(r, i, pw * 1000, t * 3600 + 5e8) for r, (p, ts) in runs.items() for i, (pw, t) in enumerate(zip(p, ts))]
    raw = spark.createDataFrame(data, "run_id string, sample_index long, `gpu.0.power` double, _timestamp double")
    plain = {r.run_id: r for r in energy_report(raw).collect()}
    monkeypatch.setattr(ordered, "BLOCK_BITS", 4)
    monkeypatch.setattr(energy, "BLOCK_BITS", 4)
    monkeypatch.setattr(ordered, "GROUP_ROWS", 50)
    mixed = {r.run_id: r for r in energy_report(raw).collect()}
    assert plain.keys() == mixed.keys() == runs.keys()
    for run, row in plain.items():
        assert row.total_energy_kwh == pytest.approx(mixed[run].total_energy_kwh, rel=1e-9)
        assert row.duration_hours == pytest.approx(mixed[run].duration_hours, rel=1e-9)
        p, t = runs[run]
        end = restated_cutoff(p, t) or len(p)
        area = sum((p[i] + p[i - 1]) / 2 * (t[i] - t[i - 1]) for i in range(1, end))
        assert row.total_energy_kwh == pytest.approx(area, rel=1e-6)


def test_trapezoid_golden(spark):
    df = table(spark, {"r": ([1.0, 3.0, 3.0], [0.0, 1.0, 3.0])})
    kept = energy.exclude_tail(energy.index_samples(df))
    assert energy.energy(kept).first().energy_per_node_kwh == 8.0


def test_power_columns_and_missing_devices(spark):
    df = spark.createDataFrame(
        [("r", 0, 100.0, None, 50.0), ("r", 1, None, None, 1.0), ("r", 2, float("nan"), 30.0, 1.0)],
        "run_id string, sample_index long, `system.gpu.0.powerWatts` double, `system.gpu.3.powerWatts` double, `gpu.0.power` double",
    )
    columns = energy.detect_power_columns(df.schema)
    assert columns == ["system.gpu.0.powerWatts", "system.gpu.3.powerWatts"]
    got = [r.power_kw for r in energy.with_power_kw(df, columns).orderBy("sample_index").collect()]
    assert got == [0.1, 0.0, 0.03]
    usable = energy.with_runtime(energy.with_power_kw(df, columns))
    assert sorted((r.sample_index, r.runtime_hours) for r in usable.collect()) == [(0, 0.0), (2, 2 / 60)]
    with pytest.raises(ValueError):
        energy.detect_power_columns(spark.range(1).schema)
    with pytest.raises(ValueError):
        energy.require_samples(usable.where("false"))


def test_runtime_column_wins(spark):
    df = spark.createDataFrame(
        [("r", 0, 1.0, 7200.0, 9.0), ("r", 1, 1.0, None, 9.0)],
        "run_id string, sample_index long, power_kw double, _runtime double, _timestamp double",
    )
    assert [r.runtime_hours for r in energy.with_runtime(df).collect()] == [2.0]


@pytest.mark.parametrize("q", [0.4, 0.0, 1.0, 0.37])
def test_percentile_is_exact(spark, q):
    rng = random.Random(2)
    runs = {f"r{n}": [round(rng.uniform(0, 3), 2) for _ in range(n)] for n in (1, 2, 5, 100)}
    df = spark.createDataFrame([(r, v) for r, vs in runs.items() for v in vs], "run_id string, power_kw double")
    got = {r.run_id: r.threshold for r in energy.power_threshold(df, fraction=q).collect()}
    for run, values in runs.items():
        assert got[run] == pytest.approx(percentile(values, q), rel=1e-12)


def test_latest_step_order(spark):
    main = spark.createDataFrame(
        [("a", None, 5.0), ("a", None, 9.0), ("b", 3.0, 100.0), ("c", None, None)],
        "run_id string, global_step double, step double",
    )
    system = spark.createDataFrame([("c", 7), ("d", 8)], "run_id string, _step long")
    got = {r.run_id: r.current_steps for r in energy.latest_step(main, system).collect()}
    assert got == {"a": 9.0, "b": 3.0, "c": 7.0, "d": 8.0}


def test_parameters_and_precedence(spark):
    df = spark.createDataFrame(
        [("a", {"seq_len": "10", "seq_length": "20", "NUM_NODES": "8"}), ("b", {}), ("c", {"batch_size": "4.0"})],
        "run_id string, config map<string,string>",
    )
    params = lambda o: {r.run_id: (r.seq_length, r.global_batch_size, r.nodes) for r in df.select("run_id", *energy.resolve_params(F.col("config"), o)).collect()}
    assert params({}) == {"a": (20, None, 8), "b": (None, None, 1), "c": (None, 4, 1)}
    assert params({"seq_length": 5, "global_batch_size": 6, "nodes": 3}) == {"a": (5, 6, 8), "b": (5, 6, 3), "c": (5, 6, 3)}


def projected(spark, steps, tokens, **targets):
    df = spark.createDataFrame(
        [(10.0, 20.0, steps, tokens)], "total_energy_kwh double, gpu_hours double, current_steps double, current_tokens long"
    )
    r = energy.project(df, **targets).first()
    return (r.predicted_energy_kwh, r.estimated_gpu_hours, r.energy_per_1k_steps, r.energy_per_billion_tokens, r.prediction_method)


def test_projection_modes(spark):
    assert projected(spark, 100.0, 10**9, target_tokens=2e9) == (20.0, 40.0, None, 10.0, "tokens")
    assert projected(spark, 100.0, 10**9, target_steps=200) == (20.0, 40.0, 100.0, 10.0, "steps")
    assert projected(spark, 100.0, None, target_steps=200) == (20.0, 40.0, 100.0, None, "steps")
    assert projected(spark, 100.0, None, target_tokens=2e9) == (None, None, None, None, None)
    assert projected(spark, 100.0, None, target_tokens=2e9, target_steps=50) == (5.0, 10.0, 100.0, None, "steps")
    assert projected(spark, None, None, target_steps=50) == (None, None, None, None, None)
    assert projected(spark, 100.0, 10**9) == (None, None, None, 10.0, None)
    with pytest.raises(ValueError):
        energy.check_targets(5, 6)


def test_summary_csv(spark):
    df = spark.createDataFrame(
        [("r", "e/p", 2, 8, 1.005, None, 3.0, 4.0, 10.0, None, None, 0.0, None)],
        "run_id string, project_path string, nodes long, gpus_per_node int, total_energy_kwh double, predicted_energy_kwh double,"
        "duration_hours double, gpu_hours double, current_steps double, current_tokens long, energy_per_1k_steps double,"
        "energy_per_billion_tokens double, prediction_method string",
    )
    row = energy.energy_summary_csv(df).first()
    assert len(row) == 14
    assert list(row)[:5] == ["r", "e/p", "2", "8", "16"]
    assert list(row)[6:] == ["N/A", "3.00", "4.00", "10.0", "N/A", "N/A", "N/A", "N/A"]
    text = spark.createDataFrame([(999.5,), (1500.0,), (None,)], "k double").select(energy.format_energy(F.col("k")).alias("t"))
    assert [r.t for r in text.collect()] == ["999.50 kWh", "1.50 MWh (1500 kWh)", None]


def test_every_run_by_its_own_names_and_clock(spark):
    """Three naming patterns, one to three devices, three clocks, and a run without samples, in one table."""
    rows = []
    for i in range(4):
        rows += [
            ("a", i, 1000.0, 2000.0, None, None, None, None, 60.0 * i, None),
            ("b", i, None, None, 500.0, None, None, None, None, 1000.0 + 120.0 * i),
            ("c", i, None, None, None, 100.0, 200.0, 300.0, None, None),
            ("d", i, None, None, None, None, None, None, 1.0 * i, None),
            (None, i, 1000.0, None, None, None, None, None, 60.0 * i, None),
        ]
    schema = (
        "run_id string, sample_index long, `system.gpu.0.powerWatts` double, `system.gpu.1.powerWatts` double, `gpu.0.power` double, "
        "`gpu_0_power_watts` double, `gpu_1_power_watts` double, `gpu_2_power_watts` double, _runtime double, _timestamp double"
    )
    raw = spark.createDataFrame(rows, schema).repartition(3)
    got = {r.run_id: r for r in energy_report(raw).collect()}
    assert set(got) == {"a", "b", "c", "d", None}
    want = {"a": (2, 3.0 * 3 / 60), "b": (1, 0.5 * 6 / 60), "c": (3, 0.6 * 3 / 60), None: (1, 1.0 * 3 / 60)}
    for run, (gpus, kwh) in want.items():
        assert got[run].status == "ok" and got[run].gpus_per_node == gpus
        assert abs(got[run].total_energy_kwh - kwh) < 1e-9
    assert abs(got["c"].avg_gpu_w - 200) < 1e-9
    assert got["d"].status == "no usable samples" and got["d"].gpus_per_node == 0 and got["d"].total_energy_kwh is None


def test_both_plans_keep_a_null_run(spark):
    rows = [(r, i, 1.0, None if r is None else 60.0 * i, 5.0 + i) for r in ("x", None) for i in range(5)]
    df = spark.createDataFrame(rows, "run_id string, sample_index long, power_kw double, _runtime double, _timestamp double")
    a, b = (sorted((tuple(r) for r in energy.with_runtime(df, blocked=x).collect()), key=str) for x in (False, True))
    assert a == b and len(a) == 10


def test_the_first_key_present_decides(spark):
    df = spark.createDataFrame([({"seq_length": "many", "seq_len": "7"},), ({"seq_len": "7"},)], "config map<string,string>")
    got = df.select(energy.resolve_params(F.col("config"))[0]).collect()
    assert [r.seq_length for r in got] == [None, 7]


def test_devices_without_a_value(spark):
    """A device that logs nothing in a whole run counts where the size of a node is given."""
    raw = spark.createDataFrame(
        [("r", i, 60.0 * i, 500.0, None) for i in range(5)] + [("none", 0, 0.0, None, None)],
        "run_id string, sample_index long, _timestamp double, `gpu.0.power` double, `gpu.1.power` double",
    )
    count = lambda **given: {r.run_id: r.gpus_per_node for r in energy_report(raw, **given).collect()}
    assert count() == {"r": 1, "none": 0}
    assert count(gpus_per_node=2) == {"r": 2, "none": 0}
