"""Shared helpers: reading tables, shared scratch folders, written intermediate tables, joins on uneven keys, components of a graph."""

from __future__ import annotations

import ctypes
import functools
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Narrow rows in a file of a written intermediate table.
ROWS_A_FILE = 100_000
#: A key is frequent with more than 1 / HOT of all rows; there are fewer than HOT such keys.
HOT = 2000


def trim() -> None:
    """Gives freed memory of this process back to the system."""
    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library; there is nothing to trim then
        pass


def lean(run: Callable) -> Callable:
    """A batch function that gives its memory back when its task ends: workers live on for other stages."""

    @functools.wraps(run)
    def wrapped(batches: Iterable) -> Iterator:
        try:
            yield from run(batches)
        finally:
            trim()

    return wrapped


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_table(spark: SparkSession, rows: Sequence[tuple], ddl: str) -> DataFrame:
    """A DataFrame of a few rows of the driver, made from Arrow: no Python worker reads it on executors."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    schema = to_arrow_schema(_parse_datatype_string(ddl))
    columns = [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)]
    return spark.createDataFrame(pa.Table.from_arrays(columns, schema=schema), ddl)


def fresh(taken: Iterable[str], name: str) -> str:
    """``name``, with underscores put before it until it clashes with none of ``taken``, whatever the case."""
    used = {t.lower() for t in taken}
    while name.lower() in used:
        name = "_" + name
    return name


def scratch_root(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where that is unset, a local master (one machine, as in tests) gets a temporary folder; anywhere else it is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.signalweave.scratch", None)
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="signalweave-")
        spark.conf.set("spark.signalweave.scratch", root)
    return root.rstrip("/")


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), p


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder name under the scratch root; the folder is deleted when the driver ends."""
    path = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
    fs, p = _fs(spark, path)
    fs.deleteOnExit(p)
    return path


class Scratch:
    """Intermediate tables of one operator. ``clear`` deletes those that nothing reads any more."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def stored(self, df: DataFrame, label: str, rows: int | None = None, each: int = ROWS_A_FILE) -> DataFrame:
        """As ``stored``; the folder goes with ``clear``."""
        out, path = _written(df, label, rows, each)
        self.paths.append(path)
        return out

    def clear(self, keep: int = 0) -> None:
        """Deletes all folders but the last ``keep``."""
        going, self.paths = self.paths[: len(self.paths) - keep], self.paths[len(self.paths) - keep :]
        for path in going:
            fs, p = _fs(self.spark, path)
            fs.delete(p, True)


def _written(df: DataFrame, label: str, rows: int | None, each: int) -> tuple[DataFrame, str]:
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    out = df if rows is None else df.coalesce(max(1, -(-rows // each)))
    out.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def stored(df: DataFrame, label: str, rows: int | None = None, each: int = ROWS_A_FILE) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends there, and a lost executor costs nothing before it.

    Where an upper bound of its ``rows`` is known, there are no more files than one for ``each`` of them. The folder is
    deleted when the driver ends.
    """
    return _written(df, label, rows, each)[0]


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def text_key(text: Column) -> Column:
    """128 bits of SHA-256 as hex: equal for equal texts only, for all practical purposes."""
    return F.substring(F.sha2(text, 256), 1, 32)


def join_uneven(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """``rows`` joined with ``table``, which has one row for each key, where some keys may have a great share of the rows.

    Adaptive execution splits the rows of a frequent key over tasks, but only if both sides come straight from an exchange.
    An aggregate by the same key would be joined where it lies; a second key column, the key's hash, gives it an exchange.
    """
    h = fresh([*rows.columns, *table.columns], "hash")
    return rows.withColumn(h, F.xxhash64(key)).join(table.withColumn(h, F.xxhash64(key)), [key, h]).drop(h)


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges(a, b)`` as ``(node, root)``; root is the smallest node.

    Alternates large-star and small-star steps until the edges no longer change. Each step is a minimum for each node,
    combined before the shuffle, and a join back, which is split where a node is the hub of a great share of the edges
    (``join_uneven``). Nodes without an edge do not appear.
    """
    tmp = Scratch(edges.sparkSession)
    cur = tmp.stored(
        edges.select("a", "b").filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "cc"
    )
    n, seen = cur.count(), None
    for _ in range(max_rounds):
        both = cur.unionByName(cur.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = join_uneven(both.filter("b > a"), low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        low2 = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            join_uneven(large, low2, "a")
            .select(F.explode(F.array(F.struct(F.col("a").alias("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
            .select("e.a", "e.b")
            .filter("a <> b")
            .distinct()
        )
        cur = tmp.stored(small, "cc", rows=2 * n)
        tmp.clear(keep=1)
        row = cur.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0)).cast("string").alias("h")).first()
        now = (row["n"], row["h"])
        if now == seen:
            break
        n, seen = row["n"], now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    # The edges are now stars: each node but the root is the first end of one edge.
    return cur.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(cur.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
