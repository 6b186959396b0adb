"""Declared schemas and row contracts; nothing is inferred."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


_TYPES = {"string": T.StringType(), "timestamp": T.TimestampType(), "double": T.DoubleType(), "boolean": T.BooleanType(), "int": T.IntegerType(), "long": T.LongType(), "strings": T.ArrayType(T.StringType())}


def columns(text: str, *before: T.StructType) -> T.StructType:
    """A schema of `name type` pairs behind the columns of others; needs no session."""
    pairs = (c.split() for c in text.split(","))
    return T.StructType([*(f for s in before for f in s), *(T.StructField(n, _TYPES[t]) for n, t in pairs)])


EXPOSURE = columns("exposure_id string, event_time timestamp, ingest_time timestamp, campaign_id string, household_id string, ip string, app_id string, program_genre string, spend double")
CONVERSION = columns("conversion_id string, event_time timestamp, ingest_time timestamp, device_id string, ip string, conversion_type string, revenue double, order_id string")
RESOLVED = columns("household_id string, resolution string, ambiguous boolean, candidate_count int", CONVERSION)
ATTRIBUTED = columns("exposure_id string, assists strings, attributed boolean, path string, processed_at timestamp, reason string, candidate_households strings", RESOLVED)
_DEVICES = T.StructField("devices", T.ArrayType(columns("device_id string, kind string")))
GRAPH = T.StructType([*columns("household_id string"), _DEVICES, *columns("ips strings")])
TRUTH = columns("conversion_id string, truth_exposure_id string")


def _is_set(values: Column) -> Column:
    return values == F.array_sort(F.array_distinct(values))


def violations(df: DataFrame) -> DataFrame:
    """Rows that break the contract of their table, with `violation`."""
    checks: list[tuple[str, Column]] = []
    names = set(df.columns)
    if "spend" in names:
        checks.append(("negative spend", F.col("spend") < 0))
    if "revenue" in names:
        checks.append(("negative revenue", F.col("revenue") < 0))
    if "conversion_type" in names:
        checks.append(("unknown conversion type", ~F.col("conversion_type").isin("site_visit", "purchase")))
    if "candidate_count" in names:
        checks.append(("candidate count below one", F.col("candidate_count") < 1))
    if "candidate_households" in names:
        many, held = F.col("candidate_count") > 1, F.col("candidate_households")
        checks += [
            ("candidates of a certain row", ~many & (F.size(held) > 0)),
            ("candidates not a sorted set", many & ~_is_set(held)),
            ("candidates disagree with their count", many & (F.size(held) != F.col("candidate_count"))),
            ("household not among the candidates", many & ~F.array_contains(held, F.col("household_id"))),
            ("reason disagrees with the candidates", F.col("reason").isNotNull() & (F.col("reason") != F.when(many, "ambiguous_ip").otherwise("state_miss"))),
            ("attributed without an exposure", F.col("attributed") & F.col("exposure_id").isNull()),
        ]
    for name in ("event_time", "ingest_time"):
        if name in names:
            checks.append((f"no {name}", F.col(name).isNull()))
    what = reduce(lambda a, c: a.when(F.coalesce(c[1], F.lit(True)), c[0]), checks, F.when(F.lit(False), ""))
    return df.withColumn("violation", what).where("violation is not null")


def backward_compatible(old: T.StructType, new: T.StructType) -> bool:
    """New readers can read old rows: no column changed its type, added ones may be null."""
    was = {f.name: f.dataType for f in old}
    return all(f.dataType == was[f.name] if f.name in was else f.nullable for f in new)
