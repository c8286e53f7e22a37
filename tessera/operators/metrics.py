"""Run metrics and data-quality checks (A1-A14) as aggregations over tables.

Every operator is a single aggregate (partial aggregation on the map side, one
shuffle of at most #groups rows per task), but for the course of gauges, a prefix sum over
ranges of time; only its totals, one for each task, are collected to the driver.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.operators.chunk import _TASK_BITS
from tessera.session import scratch_path

# Upper bounds (seconds) of the duration histogram buckets; +Inf follows.
DURATION_BUCKETS = [0.1, 0.5, 1.0, 2.5, 5.0, 10.0, 25.0, 50.0, 100.0]


def _bucket_name(b: float) -> str:
    return "le_" + (str(b).rstrip("0").rstrip(".")).replace(".", "_")


def counter(log: DataFrame, labels: list[str], value: str | Column | None = None,
            name: str = "total") -> DataFrame:
    """A1-A4: a labelled counter; ``value`` null -> +1 per row."""
    inc = F.lit(1) if value is None else (F.col(value) if isinstance(value, str) else value)
    return log.groupBy(*labels).agg(F.sum(inc).alias(name))


def requests_by_status(log: DataFrame, target: str, status: Column | str) -> DataFrame:
    """A5: request counter by target and status label."""
    st = F.col(status) if isinstance(status, str) else status
    return (log.select(F.col(target).alias(target), st.alias("status"))
               .groupBy(target, "status").agg(F.count(F.lit(1)).alias("requests")))


def duration_histogram(log: DataFrame, labels: list[str], duration: str,
                       buckets: list[float] = DURATION_BUCKETS) -> DataFrame:
    """Cumulative bucket counts (<= edge), +Inf, sum and count, in one
    aggregate (no join with a bucket table)."""
    d = F.col(duration)
    aggs = [F.count_if(d <= F.lit(b)).cast("long").alias(_bucket_name(b)) for b in buckets]
    aggs += [F.count(d).cast("long").alias("le_inf"),
             F.sum(d).alias("duration_sum"),
             F.count(d).cast("long").alias("duration_count")]
    return log.groupBy(*labels).agg(*aggs)


def last_values(log: DataFrame, labels: list[str], ts: str, value: str,
                success: Column, tie: tuple[str, ...] = ()) -> DataFrame:
    """Last value by time (set -> last wins; ``tie`` columns settle equal times),
    last attempt and last success (two columns, D21)."""
    return log.groupBy(*labels).agg(
        F.max_by(F.col(value), F.struct(ts, *tie)).alias("last_value"),
        F.max(ts).alias("last_attempt"),
        F.max(F.when(success, F.col(ts))).alias("last_success"))


def run_summary(log: DataFrame, success: Column, saved: Column, duration: str) -> DataFrame:
    """Completed, failed, total saved, total and average duration over the
    completed runs (0 when none)."""
    d = F.col(duration)
    return log.agg(
        F.count_if(success).cast("long").alias("completed"),
        F.count_if(~success).cast("long").alias("failed"),
        F.sum(F.when(success, saved).otherwise(F.lit(0))).cast("long").alias("total_saved"),
        F.coalesce(F.sum(F.when(success, d)), F.lit(0.0)).alias("total_duration"),
        F.coalesce(F.try_divide(F.sum(F.when(success, d)), F.count_if(success)),
                   F.lit(0.0)).alias("avg_duration"))


def job_counts(log: DataFrame, success: Column) -> DataFrame:
    """A10: total, successful and failed runs."""
    return log.agg(F.count(F.lit(1)).cast("long").alias("total_runs"),
                   F.count_if(success).cast("long").alias("successful_runs"),
                   F.count_if(~success).cast("long").alias("failed_runs"))


def check_suite(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """Each check is an aggregate counting failing rows (0 = healthy); all
    checks run in one aggregate over ``df``. A check that cannot be evaluated (it
    fails analysis on the driver, no job runs) gets status 'error'. Output one row
    per check plus 'overall' (healthy iff every check is healthy)."""
    usable, broken = {}, {}
    for name, c in checks.items():
        try:
            df.agg(c.alias("_probe")).schema          # analysis only
            usable[name] = c
        except Exception as e:
            broken[name] = f"{type(e).__name__}"
    names = list(usable)
    rows = None
    if names:
        agg = df.agg(*[usable[n].cast("long").alias(f"c{i}") for i, n in enumerate(names)])
        stack = ", ".join(f"'{n}', c{i}" for i, n in enumerate(names))
        rows = agg.selectExpr(f"stack({len(names)}, {stack}) as (check_name, failing)")
    else:
        agg = df.sparkSession.range(1).select()
    errs = [F.struct(F.lit(n).alias("check_name"), F.lit(None).cast("long").alias("failing")) for n in broken]
    if errs:
        err_rows = agg.select(F.explode(F.array(*errs)).alias("e")).select("e.check_name", "e.failing")
        rows = err_rows if rows is None else rows.unionByName(err_rows)
    per = rows.select("check_name", "failing",
                      F.when(F.col("failing").isNull(), "error")
                       .when(F.col("failing") == 0, "healthy").otherwise("unhealthy").alias("status"))
    total = sum((F.col(f"c{i}") for i in range(len(names))), F.lit(0))
    overall = agg.select(
        F.lit("overall").alias("check_name"), total.cast("long").alias("failing"),
        F.when((total == 0) & F.lit(not broken), "healthy").otherwise("unhealthy").alias("status"))
    return per.unionByName(overall)


def storage_health(read: Callable[[], DataFrame], spark: SparkSession, name: str) -> DataFrame:
    """One row with the status of a stored table: 'healthy' and its row count, or
    'unhealthy' and what went wrong when it is read (``read`` is run here, and counted
    with one job)."""
    try:
        found = (name, "healthy", read().count(), None)
    except Exception as e:
        found = (name, "unhealthy", None, type(e).__name__)
    return spark.createDataFrame([found], "storage string, status string, row_count long, error string")


def active_runs(log: DataFrame, started: Column, ended: Column, run_id: str = "run_id") -> DataFrame:
    """A7 gauges from a run log: runs that have begun and not ended, and their number
    (the queue of a log that holds both)."""
    runs = log.groupBy(run_id).agg(F.bool_or(started).alias("_begun"), F.bool_or(ended).alias("_ended"))
    return runs.agg(F.count_if(F.col("_begun") & ~F.col("_ended")).cast("long").alias("active_runs"),
                    F.count_if(~F.col("_begun") & ~F.col("_ended")).cast("long").alias("queue_size"))


def gauge_course(log: DataFrame, at: str, changes: dict[str, Column]) -> DataFrame:
    """A7 gauges in the course of time: ``at`` and the value of each gauge once all that
    happened at that time has. ``changes`` gives what a row adds to each gauge (null:
    nothing). Rows without a time are not counted.

    A prefix sum over the whole log without one task that sees it: changes are summed by
    time on the map side, times are range-partitioned, and a task adds up its own range;
    what went before is the sum of the earlier ranges' totals (one row for each task)."""
    spark = log.sparkSession
    names = list(changes)
    steps = log.where(F.col(at).isNotNull()).groupBy(F.col(at).alias(at)).agg(*[F.sum(F.coalesce(c, F.lit(0))).alias(n) for n, c in changes.items()])
    numbered = steps.repartitionByRange(at).sortWithinPartitions(at).withColumn("_number", F.monotonically_increasing_id())
    path = scratch_path(spark, "course")
    numbered.write.parquet(path)
    rows = spark.read.schema(numbered.schema).parquet(path).withColumn("_task", F.shiftright("_number", _TASK_BITS))
    totals = rows.groupBy("_task").agg(*[F.sum(n).alias(n) for n in names]).orderBy("_task").collect()    # a row for each task
    before, sums = [], [0] * len(names)
    for r in totals:
        before.append((r["_task"], *sums))
        sums = [s + r[n] for s, n in zip(sums, names)]
    starts = spark.createDataFrame(before, "_task long, " + ", ".join(f"_before_{i} {numbered.schema[n].dataType.simpleString()}" for i, n in enumerate(names)))
    own = Window.partitionBy("_task").orderBy("_number").rowsBetween(Window.unboundedPreceding, 0)
    return rows.join(F.broadcast(starts), "_task").select(
        at, *[(F.col(f"_before_{i}") + F.sum(n).over(own)).alias(n) for i, n in enumerate(names)])


def gauge_peaks(course: DataFrame, at: str) -> DataFrame:
    """Of each gauge of a course: its greatest value, when it was first reached, and the last value."""
    names = [c for c in course.columns if c != at]
    peak = lambda n: F.struct(F.lit(n).alias("gauge"), F.max(n).alias("peak"),
                              F.min_by(at, F.struct(-F.col(n), F.col(at))).alias("peak_at"), F.max_by(n, at).alias("last_value"))
    return course.agg(F.array(*[peak(n) for n in names]).alias("g")).select(F.explode("g").alias("g")).select("g.*")


def quality_report(df: DataFrame) -> DataFrame:
    """Rows, total null cells and duplicated rows. One shuffle, of a 256-bit digest
    for each row rather than its cells (partial aggregation first)."""
    cols = [F.col(f"`{c}`") for c in df.columns]
    nulls = sum((c.isNull().cast("long") for c in cols), F.lit(0))
    digest = F.sha2(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}), 256)
    groups = df.select(digest.alias("_row"), nulls.alias("_nulls")).groupBy("_row").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("_nulls").alias("_nulls"))
    return groups.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("rows"),
        F.coalesce(F.sum("_nulls"), F.lit(0)).cast("long").alias("null_cells"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long").alias("duplicate_rows"))
