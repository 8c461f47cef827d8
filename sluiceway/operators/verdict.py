"""Metrics against their bounds: one verdict row per check."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from sluiceway.functions.metrics import Check

RULE_SCHEMA = "metric string, category string, source string, low double, high double"


class GateFailed(Exception):
    """A gate found something; `failed` lists the checks and their values."""

    def __init__(self, layer: str, batch_id: str, failed: list[str]):
        super().__init__(f"{layer} gate failed for batch {batch_id}: {failed}")
        self.layer, self.batch_id, self.failed = layer, batch_id, failed


class EmptyBatch(GateFailed):
    """There are no rows to check."""

    def __init__(self, layer: str, batch_id: str):
        super().__init__(layer, batch_id, ["no rows"])


def rules(spark: SparkSession, checks: Sequence[Check]) -> DataFrame:
    """The bounds as a relation; its size is the length of the suite."""
    rows = [
        (c.name, c.category, c.detail, *(None if b is None else float(b) for b in (c.low, c.high)))
        for c in checks
    ]
    return spark.createDataFrame(rows, RULE_SCHEMA)


def judge(values: dict, checks: Sequence[Check]) -> list[Row]:
    """The same verdicts for one row of metrics that is already here; starts no job."""
    judged = []
    for c in checks:
        value = None if values.get(c.name) is None else float(values[c.name])
        low, high = (None if b is None else float(b) for b in (c.low, c.high))
        passed = value is not None and (low is None or value >= low) and (high is None or value <= high)
        detail = f"{'value' if passed else 'FAILED: value'}={'unknown' if value is None else value}"
        judged.append(
            Row(source=c.detail, category=c.category, metric=c.name, value=value, low=low, high=high, passed=passed, detail=detail)
        )
    return judged


def verdicts(metrics: DataFrame, checks: Sequence[Check], by: Sequence[str] = ()) -> DataFrame:
    """Unpivot the metrics and judge each; an unknown value does not pass."""
    names = [c.name for c in checks if c.name in metrics.columns]
    typed = metrics.select(*by, *[F.col(n).cast("double").alias(n) for n in names])
    long = typed.unpivot(list(by), names, "metric", "value")
    inside = (F.col("value") >= F.coalesce("low", "value")) & (F.col("value") <= F.coalesce("high", "value"))
    return (
        long.join(F.broadcast(rules(metrics.sparkSession, checks)), "metric")
        .withColumn("passed", F.coalesce(inside, F.lit(False)))
        .withColumn("detail", F.concat(F.when(F.col("passed"), "value=").otherwise("FAILED: value="),
                                       F.coalesce(F.col("value").cast("string"), F.lit("unknown"))))
        .select(*by, "source", "category", "metric", "value", "low", "high", "passed", "detail")
    )
