"""Writers: write-once, fixed columns, appends, latest and history, bounded retention."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.series import retain_newest


def write_once(df: DataFrame, path: str) -> None:
    """Refuses to overwrite."""
    df.write.mode("errorifexists").parquet(path)


def write_ledger(df: DataFrame, path: str, fields: Sequence[str]) -> None:
    """CSV of exactly these fields, missing ones empty, replacing what was there."""
    df.select(*[F.col(f).cast("string").alias(f) if f in df.columns else F.lit(None).cast("string").alias(f) for f in fields]).write.mode("overwrite").option("header", True).option("emptyValue", "").csv(path)


def append_lines(df: DataFrame, path: str, compressed: bool = True) -> bool:
    """Appends JSON lines; nothing is written for an empty table."""
    if df.isEmpty():
        return False
    df.write.mode("append").option("compression", "gzip" if compressed else "none").json(path)
    return True


def write_latest_and_history(df: DataFrame, root: str, run_day: str, run_key: str) -> None:
    df.write.mode("overwrite").parquet(f"{root}/latest")
    df.withColumns({"run_day": F.lit(run_day), "run_key": F.lit(run_key)}).write.mode("append").partitionBy("run_day", "run_key").parquet(f"{root}/history")


def write_retained(df: DataFrame, path: str, order: Sequence[Column], keep: int, key: Sequence[str] = ()) -> None:
    """Writes the newest ``keep`` rows (of each key)."""
    retain_newest(df, key, order, keep).write.mode("overwrite").parquet(path)


def markdown(df: DataFrame, title: str, columns: Sequence[str]) -> DataFrame:
    """A ``line`` column that renders rows as list items under a heading; presentation only."""
    body = df.select(F.concat(F.lit("- "), F.concat_ws(" | ", *[F.coalesce(F.col(c).cast("string"), F.lit("–")) for c in columns])).alias("line"))
    return df.sparkSession.createDataFrame([(f"## {title}",)], "line string").unionByName(body)
