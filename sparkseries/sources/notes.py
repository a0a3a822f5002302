"""Facts about a stored table that a reader must not guess, kept beside its data."""

from __future__ import annotations

import json
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: readers of the table skip folders that begin with an underscore
_FOLDER = "_notes"


def write_notes(spark: SparkSession, path: str, notes: dict[str, Any]) -> None:
    text = json.dumps(notes, sort_keys=True)
    one: DataFrame = spark.range(0, 1, 1, 1).select(F.lit(text).alias("value"))
    one.write.mode("overwrite").text(f"{path.rstrip('/')}/{_FOLDER}")


def read_notes(spark: SparkSession, path: str) -> dict[str, Any]:
    """The stored facts; empty where there is no table yet."""
    try:
        rows = spark.read.text(f"{path.rstrip('/')}/{_FOLDER}").collect()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}
    return json.loads(rows[0][0]) if rows else {}
