"""Event-time windows.

Tumbling windows are a ``groupBy(window(...))``: partial aggregation before
the shuffle, so hot keys collapse map-side.

Trailing windows ``(t - W, t]`` take time linear in the rows, however many
rows a frame has.  Row time t gets bucket ``b = t div W``; its frame is the
rows of b up to t (a running aggregate of b) and the rows of b-1 after t - W
(a running aggregate of b-1 from its end).  Both only grow, so Spark updates
them row by row, and nothing is subtracted, which keeps NaN and infinite
values right.  The second is brought to t by shifting the rows of b-1 by W
into b, in one sorted pass.  Work is split by (key, bucket): neither a key nor
the table goes to one task, only the distinct times of a key within W.  The
global window goes further: W is cut into panes, each a task of its own, whose
totals make a table of one row per pane that a second pass scans in the same way,
so a frame is the end of one pane, the panes between and the start of its own.  Rows
are first reduced to one per (key, time)
with partial aggregates, so copies of one reading collapse map-side; the
result is joined back to the rows null-safely, so rows with NULL keys stay (W5 reduces them per time,
sensor and input split in the task of their pane, and keeps their ids).
The lists of W5 are as long as the output asks, so no sort or shuffle carries them: a
W has one row that says from when and until when each name is in the frames, and
each frame picks its names from there in the step that returns it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitalis.functions.scalar import ts_micros
from vitalis.functions.stats import avg_col, fixed_avg_finish, fixed_avg_sum, odd_sum
from vitalis.schema import BLOOD_PRESSURE, SCALAR_SENSORS

US_PER_SECOND = 1_000_000


def scalar_readings(readings: DataFrame) -> DataFrame:
    """Readings that go to the scalar aggregator (everything but blood pressure)."""
    return readings.filter(F.col("sensor_type") != BLOOD_PRESSURE)


def bp_readings(readings: DataFrame) -> DataFrame:
    return readings.filter(F.col("sensor_type") == BLOOD_PRESSURE)


# --------------------------------------------------------------------------
# Tumbling windows
# --------------------------------------------------------------------------


def tumbling(
    readings: DataFrame,
    size: str = "5 seconds",
    ts: str = "ts",
    digits: int | None = None,
    valid_only: bool = False,
    valid_col: str = "is_valid",
) -> DataFrame:
    """Count / avg / min / max per (tumbling window, patient, sensor).

    ``timestamp`` is the emission time of the window, i.e. its end.  Invalid
    values are counted, as in the reference (T2), unless ``valid_only``.
    """
    data = scalar_readings(readings)
    if valid_only:
        data = data.filter(F.col(valid_col))
    g = data.groupBy(F.window(ts, size).alias("w"), "patient_id", "sensor_type").agg(
        F.count(F.lit(1)).alias("count"),
        avg_col("value", digits).alias("avg"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    return g.select(
        "patient_id",
        "sensor_type",
        F.col("w.end").alias("timestamp"),
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        "count",
        "avg",
        "min",
        "max",
    )


def tumbling_bp(readings: DataFrame, size: str = "5 seconds", ts: str = "ts", digits: int | None = None) -> DataFrame:
    """Blood-pressure tumbling window with six aggregates.

    Grouped by the real patient column, so ``P001`` stays ``P001`` (T1).
    """
    g = bp_readings(readings).groupBy(F.window(ts, size).alias("w"), "patient_id", "sensor_type").agg(
        F.count(F.lit(1)).alias("count"),
        avg_col("systolic", digits).alias("systolic_avg"),
        F.min("systolic").alias("systolic_min"),
        F.max("systolic").alias("systolic_max"),
        avg_col("diastolic", digits).alias("diastolic_avg"),
        F.min("diastolic").alias("diastolic_min"),
        F.max("diastolic").alias("diastolic_max"),
    )
    return g.select(
        "patient_id",
        "sensor_type",
        F.col("w.end").alias("timestamp"),
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        "count",
        "systolic_avg",
        "systolic_min",
        "systolic_max",
        "diastolic_avg",
        "diastolic_min",
        "diastolic_max",
    )


# --------------------------------------------------------------------------
# Trailing windows (W3-W5) with the time-bucket split
# --------------------------------------------------------------------------


def _sliding(per_time: DataFrame, keys: list[str], window_us: int, closed: bool, states: dict, panes: int = 1) -> DataFrame:
    """State of the trailing frame at each row of ``per_time`` (key columns, ``_us`` and the states' inputs).

    ``states``: name -> (aggregate of a column, combination of the states of two disjoint row sets,
    either of which may be NULL, and optionally a function of the aggregate).  Returns a row per key and time:
    keys, ``_us``, the pane ``_part`` and the states; rows of one time are peers.  With several ``panes`` (a divisor of ``window_us``)
    the states are without the panes that lie wholly inside the frame.
    """
    width = window_us // panes
    b = per_time.withColumn("_b", _pane("_us", width))
    grow = Window.partitionBy(*keys, "_b").orderBy("_us").rangeBetween(Window.unboundedPreceding, 0)
    shrink = Window.partitionBy(*keys, "_b").orderBy(F.desc("_us")).rangeBetween(Window.unboundedPreceding, 0)

    def over(w) -> Column:
        return F.struct(*[(s[2](s[0].over(w)) if len(s) > 2 else s[0].over(w)).alias(n) for n, s in states.items()])

    both = b.select(*keys, "_us", "_b", over(grow).alias("_upto"), over(shrink).alias("_since"), F.count(F.lit(1)).over(grow).alias("_n"), F.row_number().over(Window.partitionBy(*keys, "_b").orderBy("_us")).alias("_i"))
    both = both.filter("_n = _i")  # the last row of each time
    own = F.struct(F.col("_b").alias("_part"), F.col("_us").alias("_pos"), F.lit(0).alias("_kind"), F.col("_upto"), F.lit(None).cast(both.schema["_since"].dataType).alias("_since"))
    before = F.struct((F.col("_b") + panes).alias("_part"), (F.col("_us") + window_us).alias("_pos"), F.lit(1).alias("_kind"), F.lit(None).cast(both.schema["_upto"].dataType).alias("_upto"), F.col("_since"))
    placed = both.select(*keys, F.inline(F.array(own, before)))
    # from the latest place down: the last shifted row seen is the first one inside the frame
    tie = F.desc("_kind") if closed else F.asc("_kind")
    down = Window.partitionBy(*keys, "_part").orderBy(F.desc("_pos"), tie).rowsBetween(Window.unboundedPreceding, 0)
    met = placed.withColumn("_old", F.last("_since", ignorenulls=True).over(down)).filter("_kind = 0")
    return met.select(*keys, F.col("_pos").alias("_us"), "_part", *[s[1](F.col(f"_old.{n}"), F.col(f"_upto.{n}")).alias(n) for n, s in states.items()])


def _pane(us: str, width: int) -> Column:
    """Number of the pane of ``width`` that a time lies in (times before the epoch, too)."""
    return F.expr(f"({us} - pmod({us}, {width})) div {width}")


def _plus(a: Column, b: Column) -> Column:
    return F.when(a.isNull(), b).when(b.isNull(), a).otherwise(a + b)


def _same(left: str, right: str, names: list[str]) -> Column:
    """Null-safe equality of the named columns of two aliased frames."""
    out = F.lit(True)
    for n in names:
        out = out & F.col(f"{left}.{n}").eqNullSafe(F.col(f"{right}.{n}"))
    return out


def trailing(
    readings: DataFrame,
    window_us: int = 30 * US_PER_SECOND,
    ts: str = "ts",
    keys: tuple[str, ...] = ("patient_id", "sensor_type"),
    closed: bool = False,
    digits: int | None = None,
) -> DataFrame:
    """Per-row trailing stats over ``(t - W, t]`` per key (T8: open below).

    ``closed=True`` gives ``[t - W, t]``.  Rows with equal time are peers and
    see each other.  NULL keys are keys like any other; rows without a time
    have no frame and drop out.
    """
    rows = scalar_readings(readings).withColumn("_us", ts_micros(ts)).filter(F.col("_us").isNotNull())
    s = fixed_avg_sum("value", digits) if digits is not None else F.sum("value")
    odd = odd_sum("value") if digits is not None else F.lit(None).cast("double")
    per_time = rows.groupBy(*keys, "_us").agg(
        F.count(F.lit(1)).alias("_c"), F.count("value").alias("_nv"), s.alias("_s"), odd.alias("_o"),
        F.min("value").alias("_mn"), F.max("value").alias("_mx"),
    )
    states = {n: (F.sum(n), _plus) for n in ("_c", "_nv", "_s", "_o")} | {"_mn": (F.min("_mn"), F.least), "_mx": (F.max("_mx"), F.greatest)}
    f = _sliding(per_time, list(keys), window_us, closed, states)
    avg = fixed_avg_finish(F.col("_s"), F.col("_nv"), digits, F.col("_o")) if digits is not None else F.col("_s") / F.nullif("_nv", F.lit(0))
    stats = f.select(*keys, "_us", F.col("_c").alias("count"), avg.alias("avg"), F.col("_mn").alias("min"), F.col("_mx").alias("max"))
    joined = rows.alias("r").join(stats.alias("s"), _same("r", "s", [*keys, "_us"]))
    return joined.select("r.event_id", *[f"r.{k}" for k in keys], f"r.{ts}", "r.value", "s.count", "s.avg", "s.min", "s.max")


def trailing_current(
    readings: DataFrame,
    window_us: int = 30 * US_PER_SECOND,
    ts: str = "ts",
    keys: tuple[str, ...] = ("patient_id", "sensor_type"),
    digits: int | None = None,
) -> DataFrame:
    """Sliding stats of each key as of its own last reading.

    The per-key last time is a partial+final aggregate joined back on the key;
    AQE turns the join into a broadcast when the key table is small at run
    time and splits a skewed key otherwise.  No per-key sort is needed.
    """
    data = scalar_readings(readings).withColumn("_us", ts_micros(ts))
    last = data.groupBy(*keys).agg(F.max("_us").alias("_last"))
    recent = data.alias("r").join(last.alias("l"), _same("r", "l", list(keys))).filter(F.col("_us") > F.col("_last") - F.lit(window_us)).select("r.*")
    return recent.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("count"),
        avg_col("value", digits).alias("avg"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        F.max(ts).alias("last_ts"),
    )


def _snapshot_parts(over=None, digits: int | None = None) -> list[Column]:
    """Each aggregate of a snapshot once, as a hidden column (one frame pass)."""

    def ov(c: Column) -> Column:
        return c.over(over) if over is not None else c

    cols = [
        ov(F.count(F.lit(1))).alias("count"),
        ov(F.collect_set(F.coalesce(F.col("patient_id"), F.lit("unknown")))).alias("_patients"),
        ov(F.collect_set(F.coalesce(F.col("sensor_type"), F.lit("unknown")))).alias("_sensors"),
    ]
    for s in SCALAR_SENSORS:
        v = F.when(F.col("sensor_type") == s, F.coalesce(F.col("value"), F.lit(0.0)))
        cols += [
            ov(F.count(v)).alias(f"_n_{s}"),
            ov(fixed_avg_sum(v, digits) if digits is not None else F.sum(v)).alias(f"_s_{s}"),
            ov(odd_sum(v) if digits is not None else F.max(F.lit(None).cast("double"))).alias(f"_o_{s}"),
            ov(F.min(v)).alias(f"_mn_{s}"),
            ov(F.max(v)).alias(f"_mx_{s}"),
        ]
    return cols


def _snapshot_finish(digits: int | None = None) -> list[Column]:
    """Sorted lists and per-sensor {count, avg, min, max} (NULL when absent)."""
    out = [
        "count",
        F.sort_array("_patients").alias("patient_ids"),
        F.sort_array("_sensors").alias("sensor_types"),
    ]
    for s in SCALAR_SENSORS:
        n = F.col(f"_n_{s}")
        avg = fixed_avg_finish(F.col(f"_s_{s}"), n, digits, F.col(f"_o_{s}")) if digits is not None else F.col(f"_s_{s}") / n
        out.append(
            F.when(
                n > 0,
                F.struct(n.alias("count"), avg.alias("avg"), F.col(f"_mn_{s}").alias("min"), F.col(f"_mx_{s}").alias("max")),
            ).alias(s)
        )
    return out


#: Panes that the global window is cut into, at most (the largest divisor of its length up to here).
PANES = 8


def global_trailing(
    readings: DataFrame,
    window_us: int = 30 * US_PER_SECOND,
    ts: str = "ts",
    digits: int | None = None,
    panes: int = PANES,
) -> DataFrame:
    """Snapshot of the global trailing window ``[t - W, t]`` at every row.

    count, window_duration (s, last - first), sorted patient and sensor lists,
    and a {count, avg, min, max} struct per scalar sensor (NULL when absent).

    The window is cut into ``panes`` and each pane is a task of its
    own.  A pane's task gets its rows and, shifted by W, those of the pane W ago, in the one shuffle that the
    rows go through, reduces them to one per (time, sensor, input split), with the ids of its rows
    (count, exact sum, min, max), and keeps running states of both.  One row per pane holds its total; a second pass slides over these rows.  A snapshot is the
    end of the pane W ago, the panes between and the start of its own pane.  Patients and
    sensors come last (:func:`_names`), once per row of that form.
    """
    panes = max(k for k in range(1, max(1, panes) + 1) if window_us % k == 0)
    width = window_us // panes
    rows = readings.withColumn("_us", ts_micros(ts)).filter(F.col("_us").isNotNull())
    named = rows.withColumns({"_p": F.coalesce("patient_id", F.lit("unknown")), "_s": F.coalesce("sensor_type", F.lit("unknown")), "_split": F.spark_partition_id()})
    v = F.when(F.col("_s").isin(*SCALAR_SENSORS), F.coalesce(F.col("value"), F.lit(0.0))).alias("_v")
    # one shuffle takes the readings themselves to their pane and to the one W later; what is made of them in a pane stays in its task
    own = F.struct(_pane("_us", width).alias("_part"), F.lit(0).alias("_kind"), "_us", F.col(ts).alias("_ts"), "event_id", "_s", v, "_split")
    none = [F.lit(None).cast(rows.schema[n].dataType) for n in (ts, "event_id")]
    before = F.struct((_pane("_us", width) + panes).alias("_part"), F.lit(1).alias("_kind"), "_us", none[0].alias("_ts"), none[1].alias("event_id"), "_s", v, F.lit(0).alias("_split"))
    placed = named.select(F.inline(F.array(own, before))).repartition("_part").groupBy("_part", "_kind", "_us", "_ts", "_s", "_split").agg(
        F.collect_list(F.when(F.col("_kind") == 0, F.struct("event_id"))).alias("_ids"), F.count(F.lit(1)).alias("_c"), (fixed_avg_sum("_v", digits) if digits is not None else F.sum("_v")).alias("_sum"),
        (odd_sum("_v") if digits is not None else F.max(F.lit(None).cast("double"))).alias("_o"), F.min("_v").alias("_mn"), F.max("_v").alias("_mx"),
    ).withColumn("_pos", F.col("_us") + F.col("_kind") * F.lit(window_us))
    states = _frame_states()
    # from the latest place down: the shifted rows met so far are those inside the frame
    down = Window.partitionBy("_part").orderBy(F.desc("_pos"), F.desc("_kind")).rowsBetween(Window.unboundedPreceding, 0)
    up = Window.partitionBy("_part").orderBy("_us").rangeBetween(Window.unboundedPreceding, 0)
    met = placed.select("*", *[c.over(down).alias(f"{n}_old") for n, c in _states_of(1).items()]).filter("_kind = 0")
    met = met.select("*", *[c.over(up).alias(f"{n}_upto") for n, c in _states_of(0).items()])
    edges = met.select("_part", "_us", "_ts", "_ids", *[join(F.col(f"{n}_old"), F.col(f"{n}_upto")).alias(n) for n, (_, join) in states.items()])
    if panes > 1:
        totals = named.groupBy(_pane("_us", width).alias("_b")).agg(F.min("_us").alias("_first"), *_frame_parts(digits))
        # a pane's total counts from the next pane on; its own place asks for the panes before
        asks = F.struct(F.col("_b").alias("_us"), *[F.lit(None).cast(totals.schema[n].dataType).alias(n) for n in states])
        gives = F.struct((F.col("_b") + 1).alias("_us"), *states)
        between = _sliding(totals.select(F.inline(F.array(asks, gives))), [], panes - 1, False, {n: (agg(n), join) for n, (agg, join) in states.items()})
        inner = between.select(F.col("_us").alias("_part"), *[F.col(n).alias(f"{n}_between") for n in states])
        edges = edges.join(inner, "_part").select("_us", "_ts", "_ids", *[join(F.col(n), F.col(f"{n}_between")).alias(n) for n, (_, join) in states.items()])
    duration = ((F.col("_us") - F.col("_first")) / F.lit(float(US_PER_SECOND))).alias("window_duration")
    lists = F.lit(None).cast("array<string>")
    finished = edges.select("_us", "_ts", "_ids", duration, F.col("_c").alias("count"), *[n for n in states if n not in ("_first", "_c")], lists.alias("_patients"), lists.alias("_sensors"))
    finished = finished.select("_us", "_ts", "_ids", "window_duration", *_snapshot_finish(digits)).drop("patient_ids", "sensor_types")
    full = finished.withColumn("_block", _pane("_us", window_us)).join(_names(named, window_us), "_block")

    def present(names: str) -> Column:
        return F.transform(F.filter(names, lambda x: F.coalesce(x["_from"] <= F.col("_us"), F.lit(False)) | F.coalesce(x["_until"] >= F.col("_us"), F.lit(False))), lambda x: x["_name"])

    out = full.select("_ids", F.col("_ts").alias(ts), "window_duration", "count", present("_patients").alias("patient_ids"), present("_sensors").alias("sensor_types"), *SCALAR_SENSORS)
    return out.select(F.inline("_ids"), *[c for c in out.columns if c != "_ids"])


def _names(named: DataFrame, window_us: int) -> DataFrame:
    """A row per block of W: its patients and sensors in order, each with when it comes into the frames of the block and
    until when what the block before holds of it is in them."""
    block = _pane("_us", window_us)
    what = F.explode(F.array(F.struct(F.lit(0).alias("k"), F.col("_p").alias("_name")), F.struct(F.lit(1).alias("k"), F.col("_s").alias("_name"))))
    none = F.lit(None).cast("long")
    own = F.struct(block.alias("_block"), F.col("_us").alias("_from"), none.alias("_until"))
    after = F.struct((block + 1).alias("_block"), none.alias("_from"), (F.col("_us") + window_us).alias("_until"))
    told = named.select(what.alias("_x"), "_us").select("_x", F.inline(F.array(own, after)))
    each = told.groupBy("_block", "_x").agg(F.min("_from").alias("_from"), F.max("_until").alias("_until"))
    held = F.struct(F.col("_x._name").alias("_name"), "_from", "_until")
    lists = {n: F.sort_array(F.collect_list(F.when(F.col("_x.k") == k, held))).alias(n) for k, n in enumerate(("_patients", "_sensors"))}
    return each.groupBy("_block").agg(*lists.values())


def _states_of(kind: int) -> dict[str, Column]:
    """Aggregates of the rows of a kind, by the names of :func:`_frame_states`, where a row is that of one sensor."""
    of = F.col("_kind") == kind
    out = {"_first": F.min(F.when(of, F.col("_us"))), "_c": F.sum(F.when(of, F.col("_c")))}
    for sensor in SCALAR_SENSORS:
        one = of & (F.col("_s") == sensor)
        out |= {f"_{n}_{sensor}": F.sum(F.when(one, F.col(c))) for n, c in (("n", "_c"), ("s", "_sum"), ("o", "_o"))}
        out |= {f"_mn_{sensor}": F.min(F.when(one, F.col("_mn"))), f"_mx_{sensor}": F.max(F.when(one, F.col("_mx")))}
    return out


def _frame_parts(digits: int | None) -> list[Column]:
    """Count, and per scalar sensor count, sum, sum of odd values, min and max (hidden columns)."""
    out = [F.count(F.lit(1)).alias("_c")]
    for sensor in SCALAR_SENSORS:
        v = F.when(F.col("sensor_type") == sensor, F.coalesce(F.col("value"), F.lit(0.0)))
        out += [
            F.count(v).alias(f"_n_{sensor}"),
            (fixed_avg_sum(v, digits) if digits is not None else F.sum(v)).alias(f"_s_{sensor}"),
            (odd_sum(v) if digits is not None else F.max(F.lit(None).cast("double"))).alias(f"_o_{sensor}"),
            F.min(v).alias(f"_mn_{sensor}"),
            F.max(v).alias(f"_mx_{sensor}"),
        ]
    return out


def _frame_states() -> dict:
    """How the parts of disjoint row sets add up: name -> (aggregate, combination of two)."""
    out = {"_first": (F.min, F.least), "_c": (F.sum, _plus)}
    for sensor in SCALAR_SENSORS:
        out |= {f"_{x}_{sensor}": (F.sum, _plus) for x in ("n", "s", "o")}
        out |= {f"_mn_{sensor}": (F.min, F.least), f"_mx_{sensor}": (F.max, F.greatest)}
    return out


def window_rows(readings: DataFrame, window_us: int = 30 * US_PER_SECOND, ts: str = "ts") -> DataFrame:
    """Rows of the current window ``[max(t) - W, max(t)]``.

    The newest time is one value from a column-pruned aggregate (no join, no
    global sort).  It is fixed before the row scan and compared with the time
    column itself, so the bound is a pushed Parquet filter and row groups
    older than the window are skipped.
    """
    newest = newest_time(readings, ts)
    if newest is None:
        return readings.limit(0)
    span = F.expr(f"make_dt_interval(0, 0, 0, {window_us / US_PER_SECOND:.6f})")
    return readings.filter(F.col(ts) >= F.lit(newest) - span)


def newest_time(readings: DataFrame, ts: str = "ts"):
    """Largest time value (one scalar; reads only the time column)."""
    return readings.agg(F.max(ts)).first()[0]


def window_current(
    readings: DataFrame, window_us: int = 30 * US_PER_SECOND, ts: str = "ts", digits: int | None = None
) -> DataFrame:
    """One-row aggregate of the current window (count, duration, lists, per-sensor)."""
    rows = window_rows(readings, window_us, ts).withColumn("_us", ts_micros(ts))
    duration = F.when(F.count(F.lit(1)) > 1, (F.max("_us") - F.min("_us")) / F.lit(float(US_PER_SECOND))).otherwise(
        F.lit(0.0)
    )
    return rows.agg(duration.alias("window_duration"), *_snapshot_parts(None, digits)).select(
        "window_duration", *_snapshot_finish(digits)
    )


def flatten_snapshot(df: DataFrame, sep: str = ",") -> DataFrame:
    """Flat form of a snapshot: lists joined to text, sensor structs expanded."""
    cols = []
    for c in df.columns:
        if c in ("patient_ids", "sensor_types"):
            cols.append(F.array_join(F.col(c), sep).alias(c))
        elif c in SCALAR_SENSORS:
            # An absent sensor (NULL struct) has count 0 and NULL statistics.
            cols.append(F.coalesce(F.col(f"{c}.count"), F.lit(0).cast("long")).alias(f"{c}_count"))
            cols += [F.col(f"{c}.{f}").alias(f"{c}_{f}") for f in ("avg", "min", "max")]
        else:
            cols.append(F.col(c))
    return df.select(*cols)
