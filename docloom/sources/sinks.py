"""Reports and inventories: CSV and JSON writers, recogniser TSV, run receipts, the catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

WORDS = "level int, page_num int, block_num int, par_num int, line_num int, word_num int, left int, top int, width int, height int, conf double, text string"


def flat(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text, so that a row fits a CSV line."""
    nested = (T.StructType, T.ArrayType, T.MapType)
    return df.select(*[F.to_json(f.name).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name) for f in df.schema])


def write_csv(df: DataFrame, path: str) -> None:
    flat(df).write.mode("overwrite").option("header", True).option("escape", '"').option("encoding", "UTF-8").csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def read_words(spark: SparkSession, path: str) -> DataFrame:
    """The word rows of a recogniser's TSV; quotes are ordinary characters."""
    rows = spark.read.schema(WORDS).option("sep", "\t").option("header", True).option("quote", "").csv(path)
    box = {"x0": F.col("left"), "y0": F.col("top"), "x1": F.col("left") + F.col("width"), "y1": F.col("top") + F.col("height")}
    return rows.where("level = 5").select("text", *[c.alias(n) for n, c in box.items()])


def read_inventory(spark: SparkSession, path: str) -> DataFrame:
    """Table rows of a Markdown file with the heading above, one row a line, in order.

    A file is one row of a whole-text read, split inside it, so line order needs no shuffle.
    """
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", "\n")).alias("line", "text"))
    from pyspark.sql.window import Window

    w = Window.orderBy("line").rowsBetween(Window.unboundedPreceding, 0)  # one file: a few hundred lines
    marked = lines.withColumn("section", F.last(F.when(F.col("text").startswith("## "), F.substring("text", 4, 1000)), True).over(w))
    table = marked.where(F.col("text").startswith("|") & ~F.col("text").rlike(r"^\|[\s:|-]*$"))
    return table.select("line", "section", F.transform(F.split(F.regexp_replace("text", r"^\||\|$", ""), r"(?<!\\)\|"), lambda c: F.trim(c)).alias("cells"))


def receipts(runs: DataFrame, counts: DataFrame, key: str = "run_id") -> DataFrame:
    """One struct a run with its counts."""
    names = [c for c in counts.columns if c != key]
    joined = runs.join(counts, key, "left")
    return joined.select(key, F.struct(F.lit("docloom.receipt.v1").alias("contract"), *[F.col(c) for c in runs.columns if c != key], F.struct(*[F.coalesce(c, F.lit(0)).alias(c) for c in names]).alias("counts")).alias("receipt"))


def catalog(spark: SparkSession) -> DataFrame:
    """Tables, views and their columns, as Spark's catalog knows them."""
    rows = [(t.database or "", t.name, t.tableType, c.name, c.dataType) for t in spark.catalog.listTables() for c in spark.catalog.listColumns(t.name)]
    return spark.createDataFrame(rows, "database string, name string, kind string, column string, type string")
