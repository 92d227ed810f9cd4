"""Shared pieces of the operators: input columns, work folders, tasks."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

HELD_BITS = 25
BITS_IN_PART = 1 << 15  # what bitmap_construct_agg holds

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def importable(spark: SparkSession) -> None:
    """Python workers of a local session find this package wherever the driver was started."""
    have = spark.sparkContext.environment.get("PYTHONPATH", "")
    if _ROOT not in have.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(x for x in (_ROOT, have) if x)


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns an operator reads, under fixed names; others, whatever their names, are left out."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def saved(df: DataFrame, what: str) -> DataFrame:
    """Write a step's rows into the shared work folder and read them back: later steps don't recompute it."""
    spark = df.sparkSession
    path = scratch_path(spark, "llm", what)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def held_out(id_col: str = "doc_id") -> Column:
    """crc32 of the id's text modulo 3 is 1: rows that no model learns from."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1


def holding(rows: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """The rows whose key, a long, is among the ids of a one-column table, and a few others.

    A filter before a join that moves wide rows: each id sets one of 2**HELD_BITS bits, which every task gets (4 MB
    whatever the input), so that rows are told where they are read.
    """
    def place(c: str) -> Column:
        return F.pmod(F.xxhash64(F.col(c).cast("long")), F.lit(1 << HELD_BITS))

    part, at, bits = (free_name(rows, x) for x in ("held_part", "held_at", "held_bits"))
    parts = ids.select(place(ids.columns[0]).alias("h")).selectExpr(f"h div {BITS_IN_PART} as {part}", f"h % {BITS_IN_PART} as at").repartition(part)
    parts = parts.groupBy(part).agg(F.bitmap_construct_agg("at").alias(bits))
    out = rows.withColumn(at, place(key)).withColumn(part, F.expr(f"{at} div {BITS_IN_PART}")).join(F.broadcast(parts), part)
    byte = f"cast(conv(hex(substring({bits}, cast({at} % {BITS_IN_PART} div 8 + 1 as int), 1)), 16, 10) as int)"
    return out.where(f"shiftright({byte}, cast({at} % 8 as int)) & 1 = 1").select(rows.columns)


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(d, doc_id, text): d is an id that no two rows share and that sorts like (doc_id, text hash).

    Where ids are unique and there, d is doc_id itself and nothing is written or sorted.  Otherwise the rows
    are written once and numbered by a distributed sort of their ids and hashes; NULL ids come first.
    """
    docs = id_text(docs, id_col, text_col)
    odd = docs.groupBy("doc_id").count().where("count > 1 or doc_id is null").limit(1).count()
    if not odd:
        return docs.select(F.col("doc_id").alias("d"), "doc_id", "text")
    return numbered(docs, "d").select("d", "doc_id", "text")


def numbered(docs: DataFrame, name: str, id_col: str = "doc_id") -> DataFrame:
    """The rows with a number ``name`` that no two of them share and that sorts like (id, hash of the row), NULL ids first.

    The rows are written once.  Their ids and hashes are sorted into ranges; a row's number is its place in its
    range after the sizes of the ranges before it, and only these sizes (one for each range) reach the driver.
    """
    row = free_name(docs, "row_number")
    hashed = F.xxhash64(*[c for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind])
    rows = saved(docs.withColumn(row, F.monotonically_increasing_id()), "keyed")
    order = [F.col("k").asc_nulls_first(), F.col("h"), F.col("row")]
    ids = rows.select(F.col(row).alias("row"), F.col(id_col).alias("k"), hashed.alias("h")).repartitionByRange(*order).sortWithinPartitions(*order)
    # the id holds the partition above bit 33 and the place in it below
    ids = saved(ids.select("row", F.monotonically_increasing_id().alias("at")), "places")
    ids = ids.select("row", F.shiftright("at", 33).alias("part"), F.col("at").bitwiseAND(F.lit((1 << 33) - 1)).alias("place"))
    before, sizes = 0, []
    for r in ids.groupBy("part").count().orderBy("part").collect():
        sizes.append((r["part"], before))
        before += r["count"]
    sizes = docs.sparkSession.createDataFrame(sizes, "part long, before long")
    numbers = ids.join(F.broadcast(sizes), "part").select(F.col("row").alias(row), (F.col("before") + F.col("place")).alias(name))
    return rows.join(numbers, row).drop(row)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or with as many underscores before it as it takes not to clash with a column."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name = "_" + name
    return name


def with_row_key(docs: DataFrame, id_col: str = "doc_id") -> tuple[DataFrame, str]:
    """The rows and the name of a column without NULLs or repeats: the id where it is one, else a new column.

    A new column sorts like the id (see ``numbered``), so what counts as first or earlier is the same for all other
    rows whether or not some id repeats.
    """
    odd = docs.groupBy(F.col(id_col).alias("k")).count().where("count > 1 or k is null").limit(1).count()
    if not odd:
        return docs, id_col
    key = free_name(docs, "row_key")
    return numbered(docs, key, id_col), key
