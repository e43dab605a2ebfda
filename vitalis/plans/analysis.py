"""The analyzer run and the dashboard data as Spark jobs.

``run_analysis`` follows the reference's batch entry point: quality report,
clean, group, store as Parquet, then SQL over the stored files.  The cleaned
table is written to the shared folder (``spark.checkpoint.dir``) and every
later report reads that table, so their lineage starts at the written files:
a lost executor costs a re-read, not a re-clean.

``dashboard_data`` returns the DataFrames behind each dashboard panel; each is
an independent query with its own pushed-down scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from vitalis.operators import aggregate as A
from vitalis.operators import clean as C
from vitalis.operators import quality as Q
from vitalis.operators import report as O
from vitalis.schema import SCALAR_SENSORS
from vitalis.session import scratch_path
from vitalis.sources.files import sql_on_parquet
from vitalis.sources.sinks import write_parquet


def run_analysis(
    spark: SparkSession,
    readings: DataFrame,
    out_path: str | None = None,
    mode: str = "required",
    digits: int | None = None,
) -> dict[str, DataFrame]:
    """Quality report, clean, store, then grouped statistics and SQL on the stored table."""
    path = out_path or scratch_path(spark, "analysis")
    write_parquet(C.clean(readings, mode=mode), path, partition_by=["sensor_type"])
    stored = spark.read.schema(readings.schema).parquet(path)
    return {
        "quality": Q.quality_report(readings),
        "clean_path": spark.createDataFrame([(path,)], "path string"),
        "cleaned": stored,
        "by_sensor": A.by_sensor(stored, digits),
        "by_patient": A.by_patient(stored),
        "sensor_stats_sql": sql_on_parquet(spark, path, A.sensor_stats_sql_text("{src}", digits)),
        "patient_stats_sql": sql_on_parquet(spark, path, A.patient_stats_sql_text("{src}")),
    }


def run_observed(spark: SparkSession, readings: DataFrame, out_path: str | None = None, mode: str = "required") -> dict[str, DataFrame]:
    """V9, D3 and S7 in one pass: the report's counts are observed metrics that fill while the clean table is written.

    The input is scanned once.  ``report`` has total_records, issues and cleaned_records.  Metrics come with
    the tasks that succeed; if a lost executor makes Spark run a finished stage again, its rows
    would be counted again, so the observed number of cleaned rows is held against the written files'
    footers, and the plain report replaces the observed one if they differ.
    """
    path = out_path or scratch_path(spark, "observed")
    before, after = Observation(), Observation()
    cleaned = C.clean(readings.observe(before, *Q.quality_counts()), mode=mode)
    write_parquet(cleaned.observe(after, F.count(F.lit(1)).alias("cleaned_records")), path)
    stored = spark.read.schema(readings.schema).parquet(path)
    written = stored.count()  # footers only
    counts = before.get
    if after.get["cleaned_records"] == written:
        report = Q.report_of(spark.range(1).select(*[F.lit(v).cast("long").alias(k) for k, v in counts.items()]))
    else:
        report = Q.quality_report(readings)
    return {"report": report.withColumn("cleaned_records", F.lit(written).cast("long")), "cleaned": stored}


def dashboard_data(readings: DataFrame, as_of: str, digits: int | None = None) -> dict[str, DataFrame]:
    """Data behind each dashboard panel (charts themselves are not built)."""
    out = {
        "kpis": A.kpis(readings, as_of),
        "alerts": Q.alerts(readings),
        "patients": A.patient_summary(readings),
        "recent": O.recent(readings, 20),
    }
    for s in SCALAR_SENSORS:
        out[f"series_{s}"] = O.sensor_series(readings, s)
        out[f"histogram_{s}"] = A.histogram(readings, (s,), digits=digits)
    return out
