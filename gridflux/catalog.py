"""All queries of the engine and their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridflux.queries import grids, series, tables

QUERIES = {**series.QUERIES, **tables.QUERIES, **grids.QUERIES}
ORACLE_SQL = {**series.ORACLE_SQL, **tables.ORACLE_SQL, **grids.ORACLE_SQL}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.causal_curve_stats(spark, sf_dir)
