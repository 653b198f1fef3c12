"""Energy report of a fleet of runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from quern.operators.energy import (
    check_targets,
    current_tokens,
    exclude_tail,
    index_samples,
    latest_step,
    project,
    run_measures,
    run_profiles,
    with_config,
    with_run_power,
    with_runtime,
)
from quern.operators.ordered import by_group_size
from quern.session import materialize


def energy_report(
    system: DataFrame,
    main: DataFrame | None = None,
    config: DataFrame | None = None,
    nodes: int = 1,
    seq_length: int | None = None,
    global_batch_size: int | None = None,
    target_steps: float | None = None,
    target_tokens: float | None = None,
    gpus_per_node: int | None = None,
    run: str = "run_id",
    order: str = "sample_index",
) -> DataFrame:
    """One row per run with energy, GPU hours, projections and power statistics.

    Every run is read by its own column names, device count and clock. A run without a usable
    sample comes out with the status ``no usable samples`` and no figures; others are ``ok``.
    A device that logged nothing in a whole run cannot be seen there: where it is known how many a node has,
    ``gpus_per_node`` says so for every run with a power column.

    ``system`` holds power samples, ``main`` the step counters, ``config`` a
    ``(run_id, config map<string,string>)`` table. Runs that fit a task are measured behind a
    single shuffle; an oversized run is measured block by block, from its numbered samples,
    four narrow columns, written out once.
    """
    check_targets(target_steps, target_tokens)
    profiles = run_profiles(system, run)
    if gpus_per_node is not None:
        given = F.when(F.col("pattern").isNotNull(), F.lit(gpus_per_node)).otherwise(F.col("gpus_per_node"))
        profiles = profiles.withColumn("gpus_per_node", given.cast("int"))
    keyed = [c for c in (run, order, "_runtime", "_timestamp") if c in system.columns]
    powered = with_run_power(system, profiles, run).select(*keyed, "power_kw")

    def measures(rows: DataFrame, blocked: bool) -> DataFrame:
        usable = with_runtime(rows, run, order, blocked)
        samples = index_samples(usable, run, order, blocked)
        samples = samples.select(run, "idx", "n", "power_kw", "runtime_hours")
        if blocked:
            samples = materialize(samples, "samples")
        return run_measures(exclude_tail(samples, run, blocked=blocked), run)

    runs = by_group_size(powered, run, lambda r: measures(r, False), lambda r: measures(r, True))
    runs = _beside(profiles.drop("pattern"), runs, run).withColumns(
        {
            "status": F.when(F.col("energy_per_node_kwh").isNull(), "no usable samples").otherwise("ok"),
            "avg_gpu_w": F.when(F.col("gpus_per_node") > 0, F.col("avg_node_w") / F.col("gpus_per_node")),
        }
    )
    steps = latest_step(main if main is not None else system, system if main is not None else None, run)
    runs = _beside(runs, steps, run)
    if config is None:
        config = runs.sparkSession.createDataFrame([], f"{run} string, config map<string,string>")
    overrides = {"seq_length": seq_length, "global_batch_size": global_batch_size, "nodes": nodes}
    runs = with_config(runs, config, overrides, run)
    totals = runs.select(
        "*",
        (F.col("energy_per_node_kwh") * F.col("nodes")).alias("total_energy_kwh"),
        (F.col("gpus_per_node") * F.col("nodes") * F.col("duration_hours")).alias("gpu_hours"),
        current_tokens(F.col("current_steps"), F.col("seq_length"), F.col("global_batch_size")).alias(
            "current_tokens"
        ),
    )
    return project(totals, target_steps, target_tokens)


def _beside(left: DataFrame, right: DataFrame, run: str) -> DataFrame:
    """Left join of two tables with a row per run; NULL is a run like others."""
    renamed = right.withColumnRenamed(run, "__run")
    return left.join(renamed, left[run].eqNullSafe(renamed["__run"]), "left").drop("__run")
