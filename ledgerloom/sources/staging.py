"""Typed staging of landing rows, driven by the column specs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import try_date, try_timestamp
from ..schemas import STAGING, Field

METADATA = {"metadata_filename": "_source_file", "metadata_row_number": "_row_num",
            "metadata_ingest_time": "_ingested_at"}


def field(document: str, spec: Field, number_scale: int = 0) -> Column:
    """One typed value of the document; null when absent or not of the kind.

    Numbers are DECIMAL(38, scale), rounded half away from zero: the default scale 0
    drops pence, as the landing contract says; pass 2 to keep them.
    """
    def get(type_name: str) -> Column:
        return F.try_variant_get(F.col(document), f"$.{spec.path}", type_name)

    if spec.kind == "number":
        return get(f"decimal(38,{number_scale})")
    if spec.kind == "date":
        return try_date(get("string"))
    if spec.kind == "timestamp":
        return try_timestamp(get("string"))
    return get(spec.kind)


def stage(table: str, raw: DataFrame, number_scale: int = 0) -> DataFrame:
    """Staged form of a landing table: metadata columns and typed fields in one projection."""
    metadata = [F.col(k).alias(v) for k, v in METADATA.items() if k in raw.columns]
    fields = [field("record_content", f, number_scale).alias(f.name) for f in STAGING[table]]
    return raw.select(*metadata, *fields)


def stager(table: str, number_scale: int = 0) -> Callable[[DataFrame], DataFrame]:
    """``stage`` for one table, as a function of the landing rows."""
    return lambda raw: stage(table, raw, number_scale)


def lost_values(table: str, raw: DataFrame, number_scale: int = 0) -> DataFrame:
    """Per column, how many documents hold a value that the type could not take.

    One row; safe casts hide such losses, so they are counted here.
    """
    counts = []
    for f in STAGING[table]:
        present = F.try_variant_get(F.col("record_content"), f"$.{f.path}", "string").isNotNull()
        lost = present & field("record_content", f, number_scale).isNull()
        counts.append(F.count_if(lost).alias(f.name))
    return raw.agg(*counts)
