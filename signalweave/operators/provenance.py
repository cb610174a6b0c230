"""Canonical digests, sealed snapshots and run plans."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpointed


def canonical_bytes(value) -> bytes:
    """JSON with sorted keys and no blanks, as UTF-8."""
    return json.dumps(value, ensure_ascii=False, sort_keys=True, separators=(",", ":")).encode()


def canonical_digest(df: DataFrame, name: str = "digest") -> DataFrame:
    """Rows with the SHA-256 of their canonical JSON: fields by name, nulls kept, no blanks."""
    ordered = sorted(df.columns)
    return df.withColumn(name, F.sha2(F.to_json(F.struct(*ordered), {"ignoreNullFields": "false"}), 256))


def table_digest(df: DataFrame) -> DataFrame:
    """One row (rows, digest) that does not depend on the order of rows: sums of the row digests' parts, hashed."""
    d = canonical_digest(df).select("digest")
    part = lambda i: F.coalesce(F.sum(F.conv(F.substring("digest", 1 + 12 * i, 12), 16, 10).cast("decimal(38,0)")), F.lit(0)).cast("string")
    return d.agg(F.count(F.lit(1)).alias("rows"), F.sha2(F.concat_ws("|", F.count(F.lit(1)).cast("string"), *[part(i) for i in range(5)]), 256).alias("digest"))


def seal_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(name, bytes, sha256) of the files under a path: the index of a sealed bundle."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def verify_seal(sealed: DataFrame, now: DataFrame) -> DataFrame:
    """Problems of a bundle against its seal: MISSING, ADDED or CHANGED files."""
    j = sealed.select("name", F.col("sha256").alias("a")).join(now.select("name", F.col("sha256").alias("b")), "name", "full")
    problem = F.when(F.col("b").isNull(), "MISSING").when(F.col("a").isNull(), "ADDED").when(F.col("a") != F.col("b"), "CHANGED")
    return j.select("name", problem.alias("problem")).filter("problem is not null")


def freeze(df: DataFrame, lane: str) -> dict:
    """Snapshot manifest: counts by lane, the table's digest and a digest over both."""
    counts = {r[lane]: r["count"] for r in df.groupBy(lane).count().collect()}
    d = table_digest(df).first()
    body = {"counts": {str(k): v for k, v in counts.items()}, "rows": d["rows"], "digest": d["digest"]}
    return body | {"seal": hashlib.sha256(canonical_bytes(body)).hexdigest()}


def verify_frozen(df: DataFrame, lane: str, manifest: Mapping) -> list[str]:
    now, problems = freeze(df, lane), []
    body = {k: v for k, v in manifest.items() if k != "seal"}
    if hashlib.sha256(canonical_bytes(body)).hexdigest() != manifest.get("seal"):
        problems.append("SEAL")
    problems += [k.upper() for k in ("counts", "rows", "digest") if now[k] != manifest.get(k)]
    return problems


def plan_problems(tasks: DataFrame, plan: str, task: str, needs: str) -> DataFrame:
    """(plan, task, problem, detail) of run plans, a row for each task with the array of tasks that it needs.

    REPEATED with the number of rows of a task, UNKNOWN with each needed task that its plan lacks, CYCLE for tasks that can never start:
    those that need themselves, directly or not, and those that need such a one. Tasks that can start are taken away round by round, each a semi join
    on what is left, as often as the longest chain of tasks has links; paths are never listed. Null arrays need nothing; null plans and tasks are values.
    """
    t = tasks.select(F.col(plan).alias("p"), F.col(task).cast("string").alias("a"), F.col(needs).alias("n"))
    ids = t.groupBy("p", "a").agg(F.count(F.lit(1)).alias("c"))
    edges = checkpointed(t.select("p", "a", F.explode("n").alias("b")).select("p", "a", F.col("b").cast("string").alias("b")).distinct())
    known = ids.select(F.col("p").alias("q"), F.col("a").alias("k"))
    on = F.col("p").eqNullSafe(F.col("q")) & F.col("b").eqNullSafe(F.col("k"))
    out = [ids.filter("c > 1").select("p", "a", F.lit("REPEATED").alias("problem"), F.col("c").cast("string").alias("detail"))]
    out.append(edges.join(known, on, "left_anti").select("p", "a", F.lit("UNKNOWN").alias("problem"), F.col("b").alias("detail")))
    left = checkpointed(edges.join(known, on, "left_semi"))
    n = left.count()
    while n:
        waits = left.select(F.col("p").alias("q"), F.col("a").alias("k")).distinct()
        left = checkpointed(left.join(waits, on, "left_semi"))
        before, n = n, left.count()
        if n == before:
            break
    out.append(left.select("p", "a").distinct().select("p", "a", F.lit("CYCLE").alias("problem"), F.lit(None).cast("string").alias("detail")))
    rows = out[0].unionByName(out[1]).unionByName(out[2])
    return rows.select(F.col("p").alias(plan), F.col("a").alias(task), "problem", "detail")


def plan_digest(tasks: Sequence[Mapping]) -> str:
    return hashlib.sha256(canonical_bytes(list(tasks))).hexdigest()
