"""Helpers shared by the text operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketflow.session import checkpoint_dir

# Rows of one Arrow batch: a worker holds one batch at a time, so this and the longest
# texts bound its memory.
ARROW_ROWS = 1000


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder under the cluster's shared ``spark.checkpoint.dir``."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Cuts lineage: a lost executor never repeats what stands before, ids given by
    ``monotonically_increasing_id`` stay as they are, and the size of the table is known
    to the optimizer, which broadcasts it only below ``autoBroadcastJoinThreshold``.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id bigint, text string) of ``df``; every other column is left out, so extra
    columns, whatever their names, never clash with an operator's own."""
    return df.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"),
                     F.col(f"`{text_col}`").cast("string").alias("text"))


def packed(docs: DataFrame) -> DataFrame:
    """(row, doc_id, text, text_key): each whole row as one struct beside its key, so that no
    column of ``docs``, whatever its name, clashes in a join."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return docs.select(row.alias("row")).select(
        "row", F.col("row.doc_id").cast("bigint").alias("doc_id"), F.col("row.text").cast("string").alias("text")) \
        .withColumn("text_key", text_key(F.col("text")))


def unpacked(rows: DataFrame, docs: DataFrame, **changed: Column) -> DataFrame:
    """The columns of ``docs`` from ``packed`` rows, some of them changed."""
    return rows.select(*[changed.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


def text_key(text: Column) -> Column:
    """Digest of a text (null: of the empty one).  With the id it names a row's content:
    rows that share both are copies of each other and are treated alike."""
    return F.md5(F.coalesce(text, F.lit("")).cast("binary"))


def with_text_key(docs: DataFrame) -> DataFrame:
    return docs.withColumn("text_key", text_key(F.col("text")))


def map_batches(df: DataFrame, fn: Callable[[dict[str, list]], dict[str, Iterable]], schema: str,
                rows: int = ARROW_ROWS) -> DataFrame:
    """Run ``fn`` on column lists of at most ``rows`` rows; its columns become ``schema``."""
    spark = df.sparkSession
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > ARROW_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    out = arrow_schema(spark, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                got = fn(batch.slice(at, rows).to_pydict())
                yield pa.RecordBatch.from_arrays(
                    [c if isinstance(c := got[f.name], pa.Array) else pa.array(c, type=f.type) for f in out],
                    schema=out)

    return df.mapInArrow(run, schema)


def arrow_schema(spark: SparkSession, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))


def crc_mod(id_col: str, n: int):
    """crc32 of the id as text, modulo ``n`` (null id: of the empty text)."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(n))
