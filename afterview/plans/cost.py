"""What queries cost, from Spark's own task metrics: a log of runs, and the daily cost by query."""

from __future__ import annotations

import datetime as dt
import os
import time
import uuid
from collections.abc import Callable
from statistics import median

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import columns

LOG = T.StructType([
    *columns("query_tag string, kind string, query_duration_ms double, read_rows long, read_bytes long, memory_usage long"),
    T.StructField("events", T.MapType(T.StringType(), T.LongType())), *columns("event_time timestamp"),
])
#: Dollars for a second of CPU, where COST_USD_PER_CPU_SECOND says nothing else.
USD_PER_CPU_SECOND = 0.0000131


def usd_per_cpu_second() -> float:
    return float(os.environ.get("COST_USD_PER_CPU_SECOND", USD_PER_CPU_SECOND))


def _stages(spark: SparkSession, group: str) -> list:
    """What the status store knows of the stages that the jobs of a group ran."""
    context = spark.sparkContext._jsc.sc()
    context.listenerBus().waitUntilEmpty(60_000)
    store, ids = context.statusStore(), set()
    jobs = store.jobsList(None).iterator()
    while jobs.hasNext():
        job = jobs.next()
        if job.jobGroup().isDefined() and job.jobGroup().get() == group:
            each = job.stageIds().iterator()
            while each.hasNext():
                ids.add(each.next())
    return [s for s in (store.lastStageAttempt(i) for i in sorted(ids)) if s.status().toString() == "COMPLETE"]


def measure(spark: SparkSession, tag: str, run: Callable[[], DataFrame], times: int = 1) -> tuple:
    """Runs a query whole; a row of LOG with the median of the durations and the metrics of the last run."""
    context, took = spark.sparkContext, []
    for _ in range(times):
        group = f"{tag}-{uuid.uuid4().hex}"
        context.setJobGroup(group, tag)
        try:
            began = time.perf_counter()
            run().write.format("noop").mode("overwrite").save()
            took.append((time.perf_counter() - began) * 1000)
        finally:
            context.setLocalProperty("spark.jobGroup.id", None)
            context.setLocalProperty("spark.job.description", None)
    stages = _stages(spark, group)
    add = lambda f: sum(int(f(s)) for s in stages)
    events = {
        "executor_cpu_us": add(lambda s: s.executorCpuTime()) // 1000, "executor_run_ms": add(lambda s: s.executorRunTime()), "gc_ms": add(lambda s: s.jvmGcTime()),
        "shuffle_read_bytes": add(lambda s: s.shuffleReadBytes()), "shuffle_write_bytes": add(lambda s: s.shuffleWriteBytes()), "spilled_bytes": add(lambda s: s.diskBytesSpilled()), "tasks": add(lambda s: s.numTasks()),
    }
    peak = max((int(s.peakExecutionMemory()) for s in stages), default=0)
    return tag, "finish", median(took), add(lambda s: s.inputRecords()), add(lambda s: s.inputBytes()), peak, events, dt.datetime.now(dt.UTC)


def logged(spark: SparkSession, queries: dict[str, Callable[[], DataFrame]], path: str, times: int = 1) -> DataFrame:
    """Measures each query and appends to the log at `path`; the whole log."""
    rows = [measure(spark, tag, run, times) for tag, run in queries.items()]
    spark.createDataFrame(rows, LOG).coalesce(1).write.mode("append").parquet(path)
    return spark.read.schema(LOG).parquet(path)


def last_run(log: DataFrame, tag: str) -> DataFrame:
    """The newest finished run of one query."""
    return log.where((F.col("query_tag") == tag) & (F.col("kind") == "finish")).orderBy(F.desc("event_time")).limit(1)


def costs(log: DataFrame, rate: float | None = None) -> DataFrame:
    """One row for each query, of its newest run: CPU seconds are taken from the metrics, dollars are these times the rate."""
    newest = log.where("kind = 'finish'").groupBy("query_tag").agg(F.max_by(F.struct("query_duration_ms", "read_rows", "read_bytes", "memory_usage", "events", "event_time"), "event_time").alias("r")).select("query_tag", "r.*")
    cpu = F.element_at("events", F.lit("executor_cpu_us")) / 1e6
    return newest.select(F.to_date("event_time").alias("day"), "query_tag", "query_duration_ms", "read_rows", "read_bytes", "memory_usage", cpu.alias("cpu_seconds"), (cpu * (usd_per_cpu_second() if rate is None else rate)).alias("usd"), F.col("event_time").alias("measured_at"))
