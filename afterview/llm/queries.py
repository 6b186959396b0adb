"""The subpackage's queries, as the driver runs them, and their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import oracle
from .contamination import op1_decontamination
from .hostrules import op10_host_rules
from .katz import op6_katz
from .nearduplicates import op4_near_duplicates
from .packing import op2_packing
from .quality import op5_resampling
from .runindex import op9_run_index
from .secrets import op8_secrets
from .shards import op7_shards
from .suffixtree import op3_substrings

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_packing": op2_packing,
    "op3_substrings": op3_substrings,
    "op4_near_duplicates": op4_near_duplicates,
    "op5_resampling": op5_resampling,
    "op6_katz": op6_katz,
    "op7_shards": op7_shards,
    "op8_secrets": op8_secrets,
    "op9_run_index": op9_run_index,
    "op10_host_rules": op10_host_rules,
}

#: The others need checksums that DuckDB lacks, tokens, trained models or signatures.
ORACLE_SQL: dict[str, str] = oracle.ORACLE_SQL
