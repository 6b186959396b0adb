"""JSON lines: strict reading, canonical writing, compacted changelogs, bounded streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class PoisonedInput(ValueError):
    """A line that isn't a record of the declared schema."""


def read_strict(spark: SparkSession, path: str, schema: T.StructType, required: list[str] | None = None) -> DataFrame:
    """Records of a JSON lines file. A malformed line, an unknown field or a
    missing required one stops the read; nothing is skipped."""
    lines = spark.read.text(path)
    keys = F.json_object_keys("value")
    allowed = F.array(*(F.lit(n) for n in schema.names))
    needed = F.array(*(F.lit(n) for n in (required or []))).cast("array<string>")
    bad = keys.isNull() | (F.size(F.array_except(keys, allowed)) > 0) | (F.size(F.array_except(needed, keys)) > 0)
    first = lines.where(F.coalesce(bad, F.lit(True))).select("value").head()
    if first is not None:
        raise PoisonedInput(first["value"][:200])
    return spark.read.schema(schema).option("mode", "FAILFAST").option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]X").json(path)


def canonical(df: DataFrame) -> DataFrame:
    """One compact JSON text per row, keys sorted, times in UTC with microseconds."""
    columns = [F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias(c) if isinstance(df.schema[c].dataType, T.TimestampType) else F.col(c) for c in sorted(df.columns)]
    return df.select(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias("value"))


def write_canonical(df: DataFrame, path: str) -> None:
    canonical(df).write.mode("overwrite").text(path)


def produce(df: DataFrame, path: str, schema: T.StructType, check=None) -> int:
    """Validates rows against their declared columns, and what `check` finds wrong in
    them (a frame of violations), then adds them as canonical lines to a stream's
    input folder. Nothing is written unless all are right; the number written."""
    if df.schema.names != schema.names or [f.dataType for f in df.schema] != [f.dataType for f in schema]:
        raise PoisonedInput(f"columns {df.schema.simpleString()} are not {schema.simpleString()}")
    needed = [f.name for f in schema if not f.nullable]
    missing = df.where(F.array_contains(F.array(*(F.col(c).isNull() for c in needed)), True)).head() if needed else None
    wrong = missing or (check(df).head() if check else None)
    if wrong is not None:
        raise PoisonedInput(str(wrong)[:200])
    canonical(df).write.mode("append").text(path)
    return df.count()


def compacted(changes: DataFrame, key: str, order: str) -> DataFrame:
    """The last write of each key."""
    rest = [c for c in changes.columns if c != key]
    return changes.groupBy(key).agg(F.max_by(F.struct(*rest), order).alias("_r")).select(key, "_r.*")


def drained(stream: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Everything that a stream holds now, written to `path` and read back; a
    query that fails raises, so a partial drain is never taken for a whole one."""
    query = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path)
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)
