"""Intermediate tables and files in the cluster's shared folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from etalage.session import checkpoint_dir


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new folder below ``spark.checkpoint.dir`` that no other run uses."""
    return f"{checkpoint_dir(spark)}/llm/{label}-{uuid.uuid4().hex}"


def fresh_name(columns: Iterable[str], name: str) -> str:
    """``name``, or with underscores after it, so that it is none of the columns (in any case of letters)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def store(df: DataFrame, label: str, compression: str = "zstd") -> DataFrame:
    """Write a frame as parquet to the shared folder and read it back.

    This cuts the lineage: what is read later does not depend on any executor
    that took part in the writing.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
