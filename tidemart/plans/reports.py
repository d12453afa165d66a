"""Batch reports."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemart.functions.ratios import insurance_ratios, liability_share, solvency_ratios
from tidemart.operators.aggregates import salted_count
from tidemart.operators.joins import map_join

__all__ = ["insurance_ratios", "liability_share", "solvency_ratios", "regional_count"]


def regional_count(
    rows: DataFrame, regions: DataFrame, region: str, row_id: str, length: int = 2, salts: int = 16
) -> DataFrame:
    """Rows per region prefix with the region's id; `regions` holds `region_name`, `region_id`."""
    counts = salted_count(rows, region, row_id, salts, prefix_length=length)
    names = regions.withColumnRenamed("region_name", "re")
    return map_join(counts, names, "re").select("re", "cnt", "region_id")
