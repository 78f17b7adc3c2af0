"""Prediction sink."""

from __future__ import annotations

from pyspark.sql import DataFrame

from starblend.functions import three_decimals


def write_predictions(scored: DataFrame, path: str, prediction: str = "prediction") -> None:
    """Write ``user_id,business_id,prediction`` in input order, three decimals, with a header.

    ``path`` becomes a folder.  Its part files are sorted ranges: read by name they give the rows in
    input order, and no single task handles the whole output.  A small result is one part.
    """
    (
        scored.select("row_id", "user_id", "business_id", three_decimals(prediction).alias("prediction"))
        .orderBy("row_id")
        .select("user_id", "business_id", "prediction")
        .write.mode("overwrite")
        .option("header", True)
        .option("quote", "")
        .option("emptyValue", "")
        .csv(path)
    )
