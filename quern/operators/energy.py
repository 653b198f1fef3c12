"""Energy of training runs from power samples, for whole fleets of runs at once.

Samples are keyed by ``(run_id, order)``. Steps that look at a run in order exist in two plans
with equal results. By default a run is one window partition, so that a fleet needs a single
shuffle. With ``blocked`` a run is cut into blocks (see :mod:`quern.operators.ordered`) and may
hold any share of all samples; :func:`by_group_size` sends each run to the plan it needs.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from quern.operators.ordered import BLOCK_BITS, ordered_sums, whole_div, with_blocks, with_ordinal

# Power column names, tried in this order for devices 0 to 15.
POWER_PATTERNS = (
    "system.gpu.{}.powerWatts",
    "gpu.{}.power",
    "system.gpu.{}.power",
    "gpu_{}_power_watts",
    "system.gpu.{}.powerPercent",
    "gpu.{}.powerWatts",
)
MAX_DEVICES = 16
# Names of the step counter, tried in this order.
STEP_COLUMNS = (
    "iteration_step",
    "train/global_step",
    "global_step",
    "step",
    "train_step",
    "trainer/global_step",
    "_step",
)
# Configuration keys, tried in this order.
SEQ_LENGTH_KEYS = ("sequence_length", "seq_length", "max_seq_length", "seq_len", "SEQ_LEN")
BATCH_SIZE_KEYS = ("global_batch_size", "batch_size", "total_batch_size", "GLOBAL_BATCH_SIZE")
NODES_KEYS = ("NUM_NODES", "num_nodes", "n_nodes", "world_size")

#: Power at or below this many kW is a logging artefact.
MIN_POWER_KW = 0.01
#: Tail detection: fewest samples, samples never excluded, samples in the tail average,
#: shortest low run, widest smoothing window.
MIN_SAMPLES, LOOK_BACK, TAIL, LOW_RUN, MAX_SMOOTH = 30, 20, 20, 5, 5


# -- power and time ----------------------------------------------------------------------


def detect_power_columns(schema: T.StructType) -> list[str]:
    """Columns of the first naming pattern that the schema has; fails when there is none."""
    names = set(schema.fieldNames())
    for pattern in POWER_PATTERNS:
        found = [c for c in (pattern.format(i) for i in range(MAX_DEVICES)) if c in names]
        if found:
            return found
    raise ValueError("no device power column in any known form")


def with_power_kw(df: DataFrame, columns: Sequence[str], name: str = "power_kw") -> DataFrame:
    """Sum the devices' watts, missing ones as zero, and convert to kW."""
    watts = [F.coalesce(F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(0.0)), F.lit(0.0)) for c in columns]
    return df.withColumn(name, sum(watts[1:], watts[0]) / 1000)


def run_profiles(df: DataFrame, run: str = "run_id") -> DataFrame:
    """How each run was logged: ``(run, pattern, gpus_per_node)``.

    A run has the first naming pattern under which any of its samples has a value, and as many
    devices as columns of that pattern hold one; ``pattern`` is NULL and the count 0 for a run
    without any. One aggregation, combined before the shuffle. Fails if the schema has no power
    column at all.
    """
    detect_power_columns(df.schema)
    patterns = _patterns(df.schema)
    seen = {c: F.max(F.when(_no_nan(df, c).isNotNull(), 1).otherwise(0)) for cs in patterns.values() for c in cs}
    flat = df.groupBy(run).agg(*[value.alias(f"__seen_{i}") for i, value in enumerate(seen.values())])
    at = {c: F.col(f"__seen_{i}") for i, c in enumerate(seen)}
    counts = {k: sum((at[c] for c in cs[1:]), at[cs[0]]) for k, cs in patterns.items()}
    first = F.coalesce(*[F.when(n > 0, F.lit(k)) for k, n in counts.items()])
    devices = F.coalesce(*[F.when(n > 0, n) for n in counts.values()], F.lit(0))
    return flat.select(run, first.alias("pattern"), devices.cast("int").alias("gpus_per_node"))


def _patterns(schema: T.StructType) -> dict[int, list[str]]:
    names = set(schema.fieldNames())
    found = {k: [c for c in (p.format(i) for i in range(MAX_DEVICES)) if c in names] for k, p in enumerate(POWER_PATTERNS)}
    return {k: cs for k, cs in found.items() if cs}


def with_run_power(df: DataFrame, profiles: DataFrame, run: str = "run_id", name: str = "power_kw") -> DataFrame:
    """Sum each sample's watts over the columns of its run's own pattern, in kW.

    NULL where the run has no pattern. ``profiles`` has one row per run (:func:`run_profiles`).
    """
    own = profiles.select(F.col(run).alias("__run"), "pattern")
    joined = df.join(own, df[run].eqNullSafe(own["__run"]), "left")
    watts = {
        k: sum(F.coalesce(F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(0.0)), F.lit(0.0)) for c in cs)
        for k, cs in _patterns(df.schema).items()
    }
    value = F.coalesce(*[F.when(F.col("pattern") == k, w / 1000) for k, w in watts.items()])
    return joined.withColumn(name, value).drop("__run", "pattern")


def elapsed_hours(
    df: DataFrame,
    run: str = "run_id",
    order: str = "sample_index",
    timestamp: str = "_timestamp",
    blocked: bool = False,
) -> DataFrame:
    """Add ``runtime_hours``, the time since the run's first sample by ``order``."""
    seconds = F.col(timestamp).cast("double")
    if not blocked:
        first = F.first(seconds).over(Window.partitionBy(run).orderBy(order))
        return df.withColumn("runtime_hours", (seconds - first) / 3600)
    cut = with_blocks(df, order)
    per_block = cut.groupBy(run, "__block").agg(
        F.min(order).alias("__at"), F.min_by(seconds, F.col(order)).alias("__first")
    )
    earliest = Window.partitionBy(run).orderBy("__at")
    first = per_block.select(run, "__block", F.first("__first").over(earliest).alias("__first"))
    # NULL is a run like others.
    known = first.select(F.col(run).alias("__run"), F.col("__block").alias("__of"), "__first")
    out = cut.join(known.hint("merge"), cut[run].eqNullSafe(known["__run"]) & (F.col("__block") == F.col("__of")))
    hours = (seconds - F.col("__first")) / 3600
    return out.select(*[F.col(f"`{c}`") for c in df.columns], hours.alias("runtime_hours"))


def _positions(df: DataFrame, run: str, order: str, name: str, total: str | None, blocked: bool) -> DataFrame:
    if blocked:
        return with_ordinal(df, run, order, name, total=total)
    at = F.row_number().over(Window.partitionBy(run).orderBy(order)).cast("long") - 1
    out = df.withColumn(name, at)
    return out.withColumn(total, F.count("*").over(Window.partitionBy(run))) if total else out


def with_runtime(
    df: DataFrame, run: str = "run_id", order: str = "sample_index", blocked: bool = False
) -> DataFrame:
    """Usable samples as ``(run, order, power_kw, runtime_hours)``.

    Each run has its own clock: ``_runtime`` seconds if any of its samples has them, else
    ``_timestamp`` since the first sample, else one minute per sample. Samples without power or
    time, or with next to no power, are dropped.
    """
    clocks = [c for c in ("_runtime", "_timestamp") if c in df.columns]
    timed = df.select(run, order, "power_kw", *clocks)
    if "_timestamp" in clocks:
        timed = elapsed_hours(timed, run, order, blocked=blocked).withColumnRenamed("runtime_hours", "__elapsed")
    timed = _positions(timed, run, order, "__i", None, blocked)
    hours = {"_runtime": lambda: F.col("_runtime").cast("double") / 3600, "_timestamp": lambda: F.col("__elapsed")}
    has = df.groupBy(F.col(run).alias("__run")).agg(*[F.max(_no_nan(df, c).isNotNull()).alias(f"__has{c}") for c in clocks]) if clocks else None
    value = F.col("__i") / 60
    if has is not None:
        timed = timed.join(has, timed[run].eqNullSafe(has["__run"]))
        value = F.coalesce(*[F.when(F.col(f"__has{c}"), F.struct(hours[c]().alias("h"))) for c in clocks], F.struct(value.alias("h")))["h"]
    timed = timed.withColumn("runtime_hours", value)
    usable = timed.select(run, order, "power_kw", "runtime_hours")
    for name in ("power_kw", "runtime_hours"):
        usable = usable.where(F.col(name).isNotNull() & ~F.isnan(name))
    return usable.where(F.col("power_kw") > MIN_POWER_KW)


def require_samples(usable: DataFrame) -> DataFrame:
    """Fail early when no usable sample is left."""
    if usable.isEmpty():
        raise ValueError("no valid power samples after filtering")
    return usable


# -- post-processing tail ----------------------------------------------------------------


def index_samples(
    df: DataFrame, run: str = "run_id", order: str = "sample_index", blocked: bool = False
) -> DataFrame:
    """Add ``idx``, the position among the run's usable samples, and their number ``n``."""
    return _positions(df, run, order, "idx", "n", blocked)


def power_threshold(
    df: DataFrame, run: str = "run_id", fraction: float = 0.4, value: str = "power_kw"
) -> DataFrame:
    """Exact percentile per run, interpolated linearly: ``(run, n, threshold)``.

    Equal values are counted first, the counts are summed in value order over cells of 0.1 W,
    and only the two values around the wanted rank are kept. No run's values are gathered.
    """
    counts = df.groupBy(run, value).agg(F.count("*").alias("c"))
    cell = F.floor(F.col(value) * 10000)
    ranked = ordered_sums(counts, run, value, {"before": F.col("c")}, {"before": "n"}, block=cell)
    low, high, position = _ranks(fraction)
    holds = lambda rank: (F.col("before") <= rank) & (rank < F.col("before") + F.col("c"))
    ends = ranked.where(holds(low) | holds(high)).select(
        run,
        F.when(holds(low), F.col(value)).alias("a"),
        F.when(holds(high), F.col(value)).alias("b"),
        "n",
    )
    found = ends.groupBy(run).agg(F.max("a").alias("a"), F.max("b").alias("b"), F.max("n").alias("n"))
    return found.select(run, "n", _between(F.col("a"), F.col("b"), position - low).alias("threshold"))


def _ranks(fraction: float) -> tuple[Column, Column, Column]:
    """Ranks below and above the wanted position among ``n`` sorted values, and the position."""
    position = (F.col("n") - 1) * F.lit(fraction)
    low = F.floor(position)
    return low, F.least(low + 1, F.col("n") - 1), position


def _between(a: Column, b: Column, t: Column) -> Column:
    return F.when(t < 0.5, a + (b - a) * t).otherwise(b - (b - a) * (1 - t))


def _with_threshold(df: DataFrame, run: str, fraction: float) -> DataFrame:
    """Attach :func:`power_threshold` where a run is one window partition: a sort, no shuffle."""
    low, high, position = _ranks(fraction)
    rank = F.row_number().over(Window.partitionBy(run).orderBy("power_kw")) - 1
    whole = Window.partitionBy(run)
    value = lambda at: F.max(F.when(F.col("__rank") == at, F.col("power_kw"))).over(whole)
    ranked = df.withColumn("__rank", rank).select("*", value(low).alias("__a"), value(high).alias("__b"))
    return ranked.withColumn(
        "threshold", _between(F.col("__a"), F.col("__b"), position - low)
    ).drop("__rank", "__a", "__b")


def smooth_power(indexed: DataFrame, run: str = "run_id", blocked: bool = False) -> DataFrame:
    """Add ``smooth_kw``, the centred rolling mean, and the previous sample.

    The window has ``min(5, n // 10)`` samples and applies from three up; where it does not fit
    the raw value stands. Input rows carry ``idx`` and ``n``.

    With ``blocked``, runs are cut into blocks of consecutive ``idx``; a few samples of the
    neighbouring blocks come along as context, with ``own`` false, so that windows never span
    more than a block. Context rows repeat samples and are dropped by ``own`` once windows
    over ``(run, __block)`` are done.
    """
    spread = _with_context(indexed) if blocked else indexed
    along = Window.partitionBy(*_keys(run, blocked)).orderBy("idx")
    p = F.col("power_kw")
    near = {k: (F.lag(p, -k) if k < 0 else F.lead(p, k)).over(along) for k in (-2, -1, 1, 2)}
    spread = spread.select(
        "*",
        near[-2].alias("__m2"),
        near[-1].alias("__m1"),
        near[1].alias("__p1"),
        near[2].alias("__p2"),
        F.lag("runtime_hours").over(along).alias("prev_hours"),
    )
    width = F.least(F.lit(MAX_SMOOTH), whole_div(F.col("n"), 10))
    smooth = p
    for size, names in (
        (3, ("__m1", "power_kw", "__p1")),
        (4, ("__m2", "__m1", "power_kw", "__p1")),
        (5, ("__m2", "__m1", "power_kw", "__p1", "__p2")),
    ):
        cols = [F.col(c) for c in names]
        # A constant window has exactly its value as mean, whatever the sum rounds to.
        mean = F.when(F.least(*cols) == F.greatest(*cols), p).otherwise(sum(cols[1:], cols[0]) / size)
        left = size // 2
        fits = (F.col("idx") >= left) & (F.col("idx") + (size - 1 - left) < F.col("n"))
        smooth = F.when((width == size) & fits, mean).otherwise(smooth)
    if blocked:
        own = [F.col("__block"), (F.shiftright("idx", BLOCK_BITS) == F.col("__block")).alias("own")]
    else:
        own = [F.lit(True).alias("own")]
    return spread.select(
        *indexed.columns, *own, smooth.alias("smooth_kw"), F.col("__m1").alias("prev_kw"), "prev_hours"
    )


def _keys(run: str, blocked: bool) -> list[str]:
    return [run, "__block"] if blocked else [run]


def _with_context(indexed: DataFrame) -> DataFrame:
    """Every sample in its own block and, near a border, in the block that looks at it."""
    before, after = MAX_SMOOTH // 2, LOW_RUN + MAX_SMOOTH // 2
    first = F.greatest(F.shiftright(F.col("idx") - after, BLOCK_BITS), F.lit(0))
    last = F.least(F.shiftright(F.col("idx") + before, BLOCK_BITS), F.shiftright(F.col("n") - 1, BLOCK_BITS))
    return indexed.withColumn("__block", F.explode(F.sequence(first, last)))


def tail_mean(smoothed: DataFrame, run: str = "run_id") -> DataFrame:
    """Mean of the last ``min(20, n // 3)`` smoothed samples of each run."""
    tail = F.least(F.lit(TAIL), whole_div(F.col("n"), 3))
    last = smoothed.where(F.col("own") & (F.col("idx") >= F.col("n") - tail))
    return last.groupBy(run).agg(F.avg("smooth_kw").alias("tail_mean"))


def low_runs(smoothed: DataFrame, run: str = "run_id", blocked: bool = False) -> DataFrame:
    """Start of the last low stretch of each run: ``(run, cutoff, cutoff_hours)``.

    Input rows carry ``threshold``. A stretch is at least five samples below the threshold
    after sample 20. It starts right after a sample that is not low and is followed by five
    that are, so the latest such place is a plain maximum. A stretch that reaches back to
    sample 21 counts from sample 20.
    """
    names = ("__last_start", "__is_open", "__back_hours")
    per_run = _low_stretch(smoothed, run, blocked).groupBy(run).agg(
        *[a.alias(k) for k, a in _tail_aggregates().items() if k in names]
    )
    cutoff, hours = _last_low_start()
    return per_run.select(run, cutoff.alias("cutoff"), hours.alias("cutoff_hours"))


def _low_stretch(smoothed: DataFrame, run: str, blocked: bool) -> DataFrame:
    along = Window.partitionBy(*_keys(run, blocked)).orderBy("idx")
    flagged = smoothed.withColumn("__low", F.col("smooth_kw") < F.col("threshold"))
    following = [F.coalesce(F.lead("__low", k).over(along), F.lit(False)) for k in range(1, LOW_RUN + 1)]
    ahead = flagged.select(
        "*",
        *[f.alias(f"__n{k}") for k, f in enumerate(following, 1)],
        F.lead("runtime_hours").over(along).alias("__next_hours"),
    ).where("own")
    names = [F.col(f"__n{k}") for k in range(1, LOW_RUN + 1)]
    all_next = names[0]
    for name in names[1:]:
        all_next = all_next & name
    here_and_next = F.col("__low")
    for name in names[:-1]:
        here_and_next = here_and_next & name
    idx = F.col("idx")
    starts = (idx > LOOK_BACK) & ~F.col("__low") & all_next
    return ahead.select(
        *smoothed.columns,
        F.when(starts, F.struct((idx + 1).alias("i"), F.col("__next_hours").alias("h"))).alias("__start"),
        ((idx == LOOK_BACK + 1) & here_and_next).alias("__open"),
    )


def locate_tail(
    indexed: DataFrame,
    run: str = "run_id",
    fraction: float = 0.4,
    min_minutes: float = 3,
    blocked: bool = False,
) -> DataFrame:
    """Per run: ``n``, ``threshold``, ``tail_mean`` and ``cutoff``, NULL where nothing is excluded."""
    return _cutoffs(_marked(indexed, run, fraction, blocked), run, min_minutes)


def _marked(indexed: DataFrame, run: str, fraction: float, blocked: bool) -> DataFrame:
    if not blocked:
        return _low_stretch(smooth_power(_with_threshold(indexed, run, fraction), run), run, False)
    smoothed = smooth_power(indexed, run, True)
    thresholds = _per_block(power_threshold(indexed, run, fraction), run)
    return _low_stretch(smoothed.join(thresholds.drop("n").hint("merge"), [run, "__block"]), run, True)


def _per_block(runs: DataFrame, run: str) -> DataFrame:
    """Repeat each run's row, which carries ``n``, for every block of its samples."""
    last = F.shiftright(F.col("n") - 1, BLOCK_BITS)
    return runs.withColumn("__block", F.explode(F.sequence(F.lit(0).cast("long"), last)))


def _tail_aggregates() -> dict[str, Column]:
    """What the cut-off of a run depends on, as aggregates over its marked samples."""
    idx, n, hours = F.col("idx"), F.col("n"), F.col("runtime_hours")
    tail = F.least(F.lit(TAIL), whole_div(n, 3))
    return {
        "tail_mean": F.avg(F.when(idx >= n - tail, F.col("smooth_kw"))),
        "__end_hours": F.max(F.when(idx == n - 1, hours)),
        "__last_start": F.max("__start"),
        "__is_open": F.max("__open"),
        "__back_hours": F.max(F.when(idx == LOOK_BACK, hours)),
    }


def _cutoff(min_minutes: float) -> Column:
    """The cut-off from the aggregates, NULL where nothing is excluded."""
    cutoff, cutoff_hours = _last_low_start()
    applies = (
        (F.col("n") >= MIN_SAMPLES)
        & (F.col("tail_mean") <= F.col("threshold"))
        & (cutoff < F.col("n") - 1)
        & ((F.col("__end_hours") - cutoff_hours) * 60 >= min_minutes)
    )
    return F.when(applies, cutoff)


def _last_low_start() -> tuple[Column, Column]:
    start, is_open = F.col("__last_start"), F.col("__is_open")
    cutoff = F.coalesce(start["i"], F.when(is_open, F.lit(LOOK_BACK).cast("long")))
    hours = F.when(start.isNotNull(), start["h"]).when(is_open, F.col("__back_hours"))
    return cutoff, hours


def _cutoffs(marked: DataFrame, run: str, min_minutes: float) -> DataFrame:
    per_run = marked.groupBy(run).agg(
        F.max("n").alias("n"),
        F.max("threshold").alias("threshold"),
        *[a.alias(k) for k, a in _tail_aggregates().items()],
    )
    return per_run.select(run, "n", "threshold", "tail_mean", _cutoff(min_minutes).alias("cutoff"))


def exclude_tail(
    indexed: DataFrame,
    run: str = "run_id",
    fraction: float = 0.4,
    min_minutes: float = 3,
    blocked: bool = False,
) -> DataFrame:
    """Samples before the post-processing tail, with their predecessor's power and time.

    Input is :func:`index_samples`. With ``blocked`` the cut-off of a run reaches its samples
    through the run's blocks, so that samples stay where the smoothing window put them.
    """
    marked = _marked(indexed, run, fraction, blocked)
    columns = [*indexed.columns, "prev_kw", "prev_hours"]
    if not blocked:
        whole = Window.partitionBy(run)
        seen = marked.select("*", *[a.over(whole).alias(k) for k, a in _tail_aggregates().items()])
        end = F.coalesce(_cutoff(min_minutes), F.col("n"))
        return seen.where(F.col("idx") < end).select(*columns)
    cuts = _per_block(_cutoffs(marked, run, min_minutes), run).select(
        run, "__block", F.coalesce("cutoff", "n").alias("__end")
    )
    kept = marked.join(cuts.hint("merge"), [run, "__block"]).where(F.col("idx") < F.col("__end"))
    return kept.select(*columns)


# -- integration and statistics ----------------------------------------------------------


def trapezoid(y: Column, prev_y: Column, x: Column, prev_x: Column) -> Column:
    """Area under the segment from the previous sample; NULL for a first sample."""
    return (y + prev_y) / 2 * (x - prev_x)


def energy(kept: DataFrame, run: str = "run_id") -> DataFrame:
    """Energy per node and run in kWh by the trapezoid rule."""
    area = trapezoid(F.col("power_kw"), F.col("prev_kw"), F.col("runtime_hours"), F.col("prev_hours"))
    return kept.groupBy(run).agg(F.coalesce(F.sum(area), F.lit(0.0)).alias("energy_per_node_kwh"))


def power_stats(kept: DataFrame, gpus_per_node: int, run: str = "run_id") -> DataFrame:
    """Average and peak watts per node and average watts per device."""
    return kept.groupBy(run).agg(
        (F.avg("power_kw") * 1000).alias("avg_node_w"),
        (F.max("power_kw") * 1000).alias("peak_node_w"),
        (F.avg("power_kw") * 1000 / gpus_per_node).alias("avg_gpu_w"),
    )


def run_duration(kept: DataFrame, run: str = "run_id") -> DataFrame:
    return kept.groupBy(run).agg(
        (F.max("runtime_hours") - F.min("runtime_hours")).alias("duration_hours")
    )


def run_measures(kept: DataFrame, run: str = "run_id") -> DataFrame:
    """Energy, duration and power statistics of each run in one aggregation."""
    area = trapezoid(F.col("power_kw"), F.col("prev_kw"), F.col("runtime_hours"), F.col("prev_hours"))
    return kept.groupBy(run).agg(
        F.coalesce(F.sum(area), F.lit(0.0)).alias("energy_per_node_kwh"),
        (F.max("runtime_hours") - F.min("runtime_hours")).alias("duration_hours"),
        (F.avg("power_kw") * 1000).alias("avg_node_w"),
        (F.max("power_kw") * 1000).alias("peak_node_w"),
    )


def latest_step(main: DataFrame, system: DataFrame | None = None, run: str = "run_id") -> DataFrame:
    """Highest value of the first step column that holds one, main history before system."""

    def best(history: DataFrame, name: str) -> DataFrame:
        columns = [c for c in STEP_COLUMNS if c in history.columns]
        maxima = [F.max(_no_nan(history, c)) for c in columns]
        value = F.coalesce(*maxima) if maxima else F.max(F.lit(None).cast("double"))
        return history.groupBy(run).agg(value.alias(name))

    steps = best(main, "current_steps")
    if system is None:
        return steps
    return (
        steps.join(best(system, "__system_steps"), run, "full")
        .select(run, F.coalesce("current_steps", "__system_steps").alias("current_steps"))
    )


def _no_nan(df: DataFrame, name: str) -> Column:
    column = F.col(f"`{name}`").cast("double")
    return F.when(~F.isnan(column), column)


# -- parameters and projection -----------------------------------------------------------


def _first_key(config: Column, keys: Sequence[str]) -> Column:
    """The number under the first key that is present; NULL if what stands there is none."""
    first = F.coalesce(*[F.try_element_at(config, F.lit(k)) for k in keys])
    return first.try_cast("double").cast("bigint")


def resolve_params(config: Column, overrides: Mapping[str, int | None] | None = None) -> list[Column]:
    """``seq_length``, ``global_batch_size`` and ``nodes`` from a config map and the caller.

    The caller's sequence length and batch size win over the config; for nodes the config wins.
    """
    given = {k: v for k, v in (overrides or {}).items() if v is not None}
    lit = lambda name: F.lit(given[name]).cast("bigint") if name in given else None

    def pick(*choices: Column | None) -> Column:
        return F.coalesce(*[c for c in choices if c is not None])

    return [
        pick(lit("seq_length"), _first_key(config, SEQ_LENGTH_KEYS)).alias("seq_length"),
        pick(lit("global_batch_size"), _first_key(config, BATCH_SIZE_KEYS)).alias("global_batch_size"),
        pick(_first_key(config, NODES_KEYS), lit("nodes"), F.lit(1).cast("bigint")).alias("nodes"),
    ]


def with_config(
    runs: DataFrame, config: DataFrame, overrides: Mapping[str, int | None] | None = None, run: str = "run_id"
) -> DataFrame:
    """Left join of one-row-per-run ``runs`` with the parameters of ``(run, config)``.

    Both sides have a row per run, so an ordinary join on the run is even; Spark broadcasts
    the configuration when its measured size allows.
    """
    params = config.select(run, F.col("config").alias("__config"))
    joined = runs.join(params, run, "left")
    return joined.select(*runs.columns, *resolve_params(F.col("__config"), overrides))


def current_tokens(steps: Column, seq_length: Column, batch: Column) -> Column:
    """Tokens seen so far; NULL when any factor is missing or zero."""
    known = (steps != 0) & (seq_length != 0) & (batch != 0)
    return F.when(known, steps.cast("bigint") * seq_length * batch)


def check_targets(target_steps: float | None, target_tokens: float | None) -> None:
    if target_steps and target_tokens:
        raise ValueError("give target steps or target tokens, not both")


def project(
    runs: DataFrame, target_steps: float | None = None, target_tokens: float | None = None
) -> DataFrame:
    """Scale energy and GPU hours to a target, by tokens where they are known, else by steps.

    Needs ``total_energy_kwh, gpu_hours, current_steps, current_tokens``; adds
    ``predicted_energy_kwh, estimated_gpu_hours, energy_per_1k_steps,
    energy_per_billion_tokens, prediction_method``.
    """
    steps, tokens = F.col("current_steps"), F.col("current_tokens")
    kwh, hours = F.col("total_energy_kwh"), F.col("gpu_hours")
    no, has_tokens = F.lit(False), tokens.isNotNull() & (tokens != 0)
    has_steps = steps.isNotNull() & (steps > 0)
    by_tokens = has_tokens if target_tokens is not None else no
    if target_tokens is None:
        by_steps = has_steps if target_steps is not None else no
    else:
        by_steps = ~has_tokens & has_steps if target_steps else no
    idle = F.lit(target_steps is None and target_tokens is None)
    scale = F.when(by_tokens, F.lit(float(target_tokens or 0)) / tokens).when(
        by_steps, F.lit(float(target_steps or 0)) / steps
    )
    per_billion = F.when((by_tokens | by_steps | idle) & has_tokens, kwh / tokens * 1e9)
    return runs.select(
        "*",
        (kwh * scale).alias("predicted_energy_kwh"),
        (hours * scale).alias("estimated_gpu_hours"),
        F.when(by_steps, kwh / steps * 1000).alias("energy_per_1k_steps"),
        per_billion.alias("energy_per_billion_tokens"),
        F.when(by_tokens, F.lit("tokens")).when(by_steps, F.lit("steps")).alias("prediction_method"),
    )


def format_energy(kwh: Column) -> Column:
    """Readable energy: MWh with kWh in brackets from 1000 kWh up, else kWh."""
    large = F.format_string("%.2f MWh (%.0f kWh)", kwh / 1000, kwh)
    return F.when(kwh >= 1000, large).when(kwh.isNotNull(), F.format_string("%.2f kWh", kwh))


def energy_summary_csv(summary: DataFrame) -> DataFrame:
    """The fourteen text columns of the summary table; NULL is written as N/A."""
    nonzero = lambda name: F.when(F.col(name) != 0, F.col(name))
    text = lambda c: F.coalesce(c.cast("string"), F.lit("N/A"))

    def decimals(c: Column) -> Column:
        return F.when(c.isNull(), F.lit("N/A")).otherwise(F.format_string("%.2f", c))

    steps = F.col("current_steps").cast("double")
    return summary.select(
        text(F.col("run_id")).alias("run_id"),
        text(F.col("project_path")).alias("project"),
        text(F.col("nodes")).alias("nodes"),
        text(F.col("gpus_per_node")).alias("gpus_per_node"),
        text(F.col("nodes") * F.col("gpus_per_node")).alias("total_gpus"),
        decimals(F.col("total_energy_kwh")).alias("energy_kwh"),
        decimals(F.col("predicted_energy_kwh")).alias("predicted_energy_kwh"),
        decimals(F.col("duration_hours")).alias("duration_hours"),
        decimals(F.col("gpu_hours")).alias("gpu_hours"),
        F.when(steps.isNull(), F.lit("N/A")).otherwise(F.format_string("%.1f", steps)).alias("current_steps"),
        decimals(nonzero("current_tokens") / 1e9).alias("current_tokens_B"),
        decimals(nonzero("energy_per_1k_steps")).alias("energy_per_1k_steps"),
        decimals(nonzero("energy_per_billion_tokens")).alias("energy_per_B_tokens"),
        text(F.col("prediction_method")).alias("prediction_method"),
    )
