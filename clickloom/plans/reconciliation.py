"""Reconciliation of configured datasets."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from clickloom.operators.recon import Reconciliation, reconcile
from clickloom.sources.tables import fetch


def reconcile_dataset(
    spark: SparkSession,
    dataset: Mapping[str, str],
    *,
    nan_differs: bool = False,
    **frames: DataFrame,
) -> Reconciliation:
    """Compare the two queries of a dataset: ``source1_sql``, ``source2_sql``, ``identifier``.

    ``frames`` are DataFrames that the queries name in braces.
    """
    source1, source2 = fetch(spark, [dataset["source1_sql"], dataset["source2_sql"]], **frames)
    return reconcile(source1, source2, dataset["identifier"], nan_differs=nan_differs)


def reconcile_datasets(
    spark: SparkSession, config: Mapping[str, Mapping[str, Mapping[str, str]]], **frames: DataFrame
) -> dict[str, Reconciliation]:
    """All datasets of a configuration ``{"datasets": {name: dataset}}``, by name."""
    return {name: reconcile_dataset(spark, d, **frames) for name, d in config["datasets"].items()}
