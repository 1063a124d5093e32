"""Sinks other than the parquet table: external connectors and the console."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame


def env_options(prefix: str) -> dict[str, str]:
    """Connector options from the environment: ``<PREFIX>_<option>``.

    Addresses and credentials stay out of code and of files.
    """
    mark = prefix + "_"
    return {k[len(mark):]: v for k, v in os.environ.items() if k.startswith(mark)}


def write_external(rows: DataFrame, table: str, fmt: str, table_option: str = "collection",
                   options: dict[str, str] | None = None) -> None:
    """Append ``rows`` through a connector that upserts on ``_id`` itself."""
    rows.write.format(fmt).mode("append").options(**(options or {})) \
        .option(table_option, table).save()


def preview(rows: DataFrame, n: int = 20) -> None:
    """Print the first rows untruncated.  Runs the plan; meant for debugging."""
    rows.show(n, truncate=False)
