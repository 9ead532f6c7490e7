"""Reading the given tables, and staging frames in the folder all executors share."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardvigil.session import new_folder

_ROOT = str(Path(__file__).resolve().parents[2])


#: Rows in a batch that goes to Python, where the session has Spark's own default: texts are long.
BATCH_ROWS = "2000"
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def importable(spark: SparkSession) -> SparkSession:
    """Lets Python workers look for this package where the driver found it.

    Workers of a local session need no more; a cluster gets the package with ``--py-files``.
    """
    if spark.conf.get(_BATCH, "10000") == "10000":
        spark.conf.set(_BATCH, BATCH_ROWS)
    environment = spark.sparkContext.environment
    known = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if _ROOT not in known:
        environment["PYTHONPATH"] = os.pathsep.join([*known, _ROOT])
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return importable(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def staged(frame: DataFrame, name: str) -> DataFrame:
    """The frame written once as Parquet below ``spark.checkpoint.dir`` and reread.

    Lineage ends there, so a lost executor costs a reread and not a recomputation.
    """
    spark = importable(frame.sparkSession)
    path = new_folder(spark, name)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def hex_sha256(text: Column) -> Column:
    """Lowercase hex SHA-256 of a string's UTF-8 bytes."""
    return F.sha2(text.cast("binary"), 256)
