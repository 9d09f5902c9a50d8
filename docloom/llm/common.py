"""What the corpus operators share: the shared folder, word hashing, ranks without one large group.

Nothing here collects rows of a corpus; tables that cut lineage are written to the folder that the
cluster names in ``spark.checkpoint.dir`` and are read again by Spark's own reader.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docloom.session import ship  # noqa: F401  operators take it from here

#: Words are runs of bytes other than these (fixed value of the contract).
WORD = r"[^\x20\x09-\x0D]+"
MASK = (1 << 64) - 1


# --- session and shared folder ------------------------------------------------------------------


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; a temporary one is set only where none is configured and all tasks run on this machine."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="docloom-shared-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def workspace(spark: SparkSession, label: str) -> str:
    """A fresh path for one written table; the application's folder goes when the driver ends."""
    top = f"{shared_dir(spark)}/docloom-{spark.sparkContext.applicationId}"
    _forget_at_exit(spark, top)
    return f"{top}/{label}-{uuid.uuid4().hex[:12]}"


_tops: set[str] = set()


def _forget_at_exit(spark: SparkSession, top: str) -> None:
    if top not in _tops:
        _tops.add(top)
        atexit.register(_remove, spark, top)


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    except Exception:  # noqa: BLE001  the session may be gone already; the folder is only left over
        pass


def drop_table(spark: SparkSession, path: str) -> None:
    """Removes a written table through Hadoop's file system."""
    _remove(spark, path)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Cuts lineage: writes ``df`` as Parquet to the shared folder and reads it again."""
    return written(df, label)[0]


def written(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """As ``materialize``, with the path, for tables that are dropped before the application ends."""
    spark = df.sparkSession
    path = workspace(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def positioned(df: DataFrame, by_path: bool = False) -> tuple[DataFrame, str, str]:
    """``df`` with two more columns, and their names: a row's file (a hash, or its path) and its number there.

    That tells equal rows apart, and is the same in every read. What does not come from Parquet files is written first.
    """
    file, row = free_name(df, "_file"), free_name(df, "_row")
    for once in (df, None):
        once = materialize(df, "rows") if once is None else once
        try:
            meta = once.metadataColumn("_metadata")
            return once.select("*", (meta["file_path"] if by_path else F.xxhash64(meta["file_path"])).alias(file), meta["row_index"].alias(row)), file, row
        except AnalysisException:
            if once is not df:
                raise
    raise AssertionError("unreachable")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or a longer one that no column of ``df`` has (names that differ in case only clash)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def quoted(names: list[str]) -> list[Column]:
    """Columns by name, whatever characters their names have."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in names]


def with_arrow_columns(docs: DataFrame, column: str, make, added: list[tuple[str, str]]) -> DataFrame:
    """``docs`` with columns (name, type) that ``make``, called in each task, computes from batches of ``column``.

    Columns travel under plain names, so any name may occur in ``docs``.
    """
    ship(docs.sparkSession)
    names = docs.columns
    at, plain = names.index(column), [f"_{i}" for i in range(len(names))]
    new = [f"_{len(names) + i}" for i in range(len(added))]
    schema = ", ".join([*(f"{n} {f.dataType.simpleString()}" for n, f in zip(plain, docs.schema)), *(f"{n} {t}" for n, (_, t) in zip(new, added))])

    def run(batches):
        import pyarrow as pa

        compute = make()
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, *compute(batch.column(at))], names=[*plain, *new])

    return docs.toDF(*plain).mapInArrow(run, schema).toDF(*names, *[n for n, _ in added])


# --- ranks ----------------------------------------------------------------------------------------


def ranked(df: DataFrame, group: list[str], order: list[Column], rank: str, rows_per_bucket: int = 2_000) -> DataFrame:
    """``df`` with a gapless rank from 0 in each group, however many rows one group holds.

    A group is cut into buckets of about ``rows_per_bucket`` rows by a hash of a row's place in the written table, so
    equal rows spread, too; rows are numbered inside their bucket and shifted by the rows of earlier buckets, so no
    task sees a whole hot group. ``df`` must be a written table. Ties in ``order`` get any order.
    """
    total = df.groupBy(*group).count().agg(F.max("count").alias("n")).first()["n"] or 0
    n = max(1, -(-total // rows_per_bucket))
    placed, file, row = positioned(df)
    tagged = placed.withColumn("_b", F.pmod(F.xxhash64(file, row), F.lit(n)).cast("int")).drop(file, row)
    w = Window.partitionBy(*group, "_b").orderBy(*order)
    if n == 1:
        return tagged.withColumn(rank, (F.row_number().over(w) - 1).cast("long")).drop("_b")
    before = Window.partitionBy(*group).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    base = tagged.groupBy(*group, "_b").agg(F.count(F.lit(1)).alias("_n"))
    base = base.withColumn("_base", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    keys = [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in [*group, "_b"]]
    on = keys[0]
    for k in keys[1:]:
        on = on & k
    numbered = tagged.withColumn("_r", F.row_number().over(w) - 1)
    return (
        numbered.alias("l")
        .join(base.alias("r"), on)
        .select(*[F.col(f"l.{c}") for c in df.columns], (F.col("_r") + F.col("_base")).cast("long").alias(rank))
    )


def number_copies(copies: Column, chunk: int = 4096) -> tuple[Column, Column]:
    """Two generators for the numbers 0 to ``copies`` - 1: chunks, then numbers of the chunk ``_chunk``; no long array."""
    outer = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((copies - 1) / chunk)))
    first = F.col("_chunk") * chunk
    return outer, F.explode(F.sequence(first, F.least(first + (chunk - 1), copies - 1)))


# --- words and hashes ---------------------------------------------------------------------------------


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser over uint64 (overflow wraps)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], dtype=np.uint64)


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of all runs of ``size`` words; fewer words are one run; none: empty."""
    n = len(words)
    if n == 0:
        return words
    take = min(n, size)
    out = np.zeros(n - take + 1, dtype=np.uint64)
    for i in range(take):
        out += mix64(words[i : n - take + 1 + i] + np.uint64(i)) * _MULTIPLIERS[i % 8]
    out = mix64(out + np.uint64(take))
    out.sort()
    return out[np.concatenate(([True], out[1:] != out[:-1]))]
