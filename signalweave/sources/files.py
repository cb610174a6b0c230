"""Readers: zipped tables with encodings to try, ledgers, line archives, newest snapshots and tables inside JSON."""

from __future__ import annotations

import csv
import io
import re
import zipfile
from collections.abc import Iterable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.cells import last_wins

ENCODINGS = ("utf-8-sig", "cp949", "euc-kr")


def decode(raw: bytes, encodings: Sequence[str] = ENCODINGS) -> str:
    """Text by the first encoding that fits; ValueError if none does."""
    for e in encodings:
        try:
            return raw.decode(e)
        except UnicodeDecodeError:
            continue
    raise ValueError("no encoding fits")


def delimiter(header: str) -> str:
    """Tab if the header has more tabs than commas."""
    return "\t" if header.count("\t") > header.count(",") else ","


def read_zipped_csv(spark: SparkSession, path: str, columns: Sequence[str], member: str = r"\.csv$", encodings: Sequence[str] = ENCODINGS) -> DataFrame:
    """Rows of the CSV members of ZIP files whose name matches ``member``: file, member, ``columns`` as strings.

    Members are chosen before they are unpacked. One archive is a task's unit: it is a file that can't be split.
    """
    names = list(columns)
    schema = "file string, member string, " + ", ".join(f"`{c}` string" for c in names)

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for where, content in zip(frame["path"], frame["content"], strict=True):
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    for info in z.infolist():
                        if not re.search(member, info.filename):
                            continue
                        text = decode(z.read(info), encodings)
                        head = text.split("\n", 1)[0]
                        reader = csv.DictReader(io.StringIO(text), delimiter=delimiter(head))
                        rows: list[list] = []
                        for r in reader:
                            rows.append([where, info.filename, *[r.get(c) for c in names]])
                            if len(rows) >= 10_000:
                                yield pd.DataFrame(rows, columns=["file", "member", *names])
                                rows = []
                        if rows:
                            yield pd.DataFrame(rows, columns=["file", "member", *names])

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInPandas(run, schema)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header, all strings; a byte-order mark is no part of the first name."""
    df = spark.read.csv(path, header=True, multiLine=True, escape='"')
    return df.toDF(*[c.lstrip("﻿") for c in df.columns])


def read_line_archive(spark: SparkSession, path: str, schema: str | T.StructType, key: Sequence[str], ordinal: Sequence[str]) -> DataFrame:
    """JSON lines, compressed or not, one row per key: the one of the highest ordinal."""
    return last_wins(spark.read.schema(schema).json(path), key, ordinal)


def newest_file(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(path, modified) of the newest file, as one row; equal times go to the greater path. Contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select("path", F.col("modificationTime").alias("modified"))
    return files.orderBy(F.desc("modified"), F.desc("path")).limit(1)


def first_available(preferred: DataFrame, other: DataFrame, key: str, stale: str) -> DataFrame:
    """Rows of ``preferred`` that are not stale; of keys it lacks, or has only stale, the rows of ``other``."""
    good = preferred.filter(~F.coalesce(F.col(stale), F.lit(False))).withColumn("route", F.lit("preferred"))
    rest = other.join(good.select(key).distinct(), key, "left_anti").withColumn("route", F.lit("other"))
    return good.unionByName(rest, allowMissingColumns=True)
