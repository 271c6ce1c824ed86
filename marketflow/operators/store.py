"""Atomic table storage on plain Parquet directories.

Without a table format there is no MERGE and no multi-file atomic commit, so:

* **Rebuilt tables** (marts, the upserted mapping, state tables) are written to
  a new ``version=<n>`` directory; readers take the highest version whose
  ``_SUCCESS`` marker exists (Spark's job-commit marker).  A failed or running
  write is never visible and nothing being read is ever overwritten.  With a
  ``database``, each version is a table of the Spark catalog (bucketed where a
  key is given) and a persistent view of the table's own name selects the newest:
  readers of every session resolve that name when they read.
* **Append-only tables** (raw feeds, fill events) are laid out
  ``<period col>=<period>/batch=<id>/``, written with *dynamic* partition
  overwrite: a retried batch replaces exactly its own ``(period, batch)``
  directories (idempotent), and uncommitted output stays in a hidden staging
  folder.  Period first means a time-bounded read lists only the periods it
  needs, however many batches have landed.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


# Most of what a load writes are its tables: the smaller codec pays at every size.
CODEC = "zstd"


class TableStore:
    """Tables under one root folder.  A write never removes anything: old versions go with
    ``expire``, a maintenance call of its own."""

    def __init__(self, spark: SparkSession, root: str, database: str | None = None, buckets: int = 8):
        self.spark = spark
        self.root = root.rstrip("/")
        self.database = database
        # files of a bucketed table: as many as tasks that should read it at once
        self.buckets = buckets
        if database:
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{self.root}/_catalog'")

    # --- filesystem --------------------------------------------------------------
    def _fs_path(self, path: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def _children(self, path: str, prefix: str) -> list[str]:
        fs, p = self._fs_path(path)
        if not fs.exists(p):
            return []
        return [s.getPath().getName() for s in fs.listStatus(p)
                if s.isDirectory() and s.getPath().getName().startswith(prefix)]

    def _committed(self, path: str) -> bool:
        fs, p = self._fs_path(f"{path}/_SUCCESS")
        return bool(fs.exists(p))

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    # --- versioned tables -----------------------------------------------------------
    def versions(self, name: str) -> list[int]:
        out = []
        for child in self._children(self.path(name), "version="):
            if self._committed(f"{self.path(name)}/{child}"):
                out.append(int(child.split("=", 1)[1]))
        return sorted(out)

    def exists(self, name: str) -> bool:
        return bool(self.versions(name)) or bool(self._periods(name))

    def _periods(self, name: str) -> list[str]:
        """Period directories (``<col>=<value>``) of an append-only table."""
        return [d for d in self._children(self.path(name), "")
                if "=" in d and not d.startswith(("_", ".", "version="))]

    def write_version(self, df: DataFrame, name: str, bucket_by: str | None = None) -> int:
        taken = [int(c.split("=", 1)[1]) for c in self._children(self.path(name), "version=")]
        version = (max(taken) + 1) if taken else 1
        path = f"{self.path(name)}/version={version}"
        if self.database and bucket_by:
            # one file a bucket; a table of that version that is there already is an error
            (df.repartition(self.buckets, bucket_by).write.bucketBy(self.buckets, bucket_by).sortBy(bucket_by)
             .option("path", path).option("compression", CODEC).mode("errorifexists").saveAsTable(self._table(name, version)))
            self.point_view(name, version)
        else:
            df.write.mode("errorifexists").option("compression", CODEC).parquet(path)
        return version

    # --- catalog --------------------------------------------------------------------
    def view(self, name: str) -> str:
        """The catalog name of a table: ``marts/dim_items`` is ``<database>.dim_items``."""
        return f"{self.database}.{name.split('/', 1)[-1].replace('/', '_')}"

    def _table(self, name: str, version: int) -> str:
        return f"{self.view(name)}__v{version}"

    def point_view(self, name: str, version: int) -> None:
        """The table's view shows this version from now on, in every session."""
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.view(name)} AS SELECT * FROM {self._table(name, version)}")

    def define_view(self, name: str, select: str) -> None:
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.database}.{name} AS {select}")

    def in_catalog(self, name: str) -> bool:
        return bool(self.database) and self.spark.catalog.tableExists(name)

    def attach(self, name: str, schema: T.StructType, bucket_by: str) -> None:
        """Enter the newest stored version into a catalog that does not know it, such as that of a
        new application without a shared metastore."""
        version = (self.versions(name) or [0])[-1]
        if not version or self.in_catalog(self._table(name, version)):
            return
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        self.spark.sql(f"CREATE TABLE {self._table(name, version)} ({columns}) USING parquet CLUSTERED BY ({bucket_by}) "
                       f"SORTED BY ({bucket_by}) INTO {self.buckets} BUCKETS LOCATION '{self.path(name)}/version={version}'")
        self.point_view(name, version)

    def expire(self, name: str, older_than: dt.timedelta) -> list[int]:
        """Maintenance: remove versions that a newer one replaced longer than ``older_than``
        ago, and the pins of batches that old; no reader or replay may be older than that.  A
        version that a younger pin names stays."""
        limit = dt.datetime.now(dt.timezone.utc).timestamp() * 1000 - older_than.total_seconds() * 1000
        base = f"{self.path(name)}/_base"
        pinned = set()
        for key in self._children(base, ""):
            fs, folder = self._fs_path(f"{base}/{key}")
            if fs.getFileStatus(folder).getModificationTime() < limit:
                fs.delete(folder, True)
            else:
                pinned |= {int(v) for v in self._children(f"{base}/{key}", "")}
        committed = self.versions(name)
        removed = []
        for version, newer in zip(committed, committed[1:]):
            fs, done = self._fs_path(f"{self.path(name)}/version={newer}/_SUCCESS")
            if fs.getFileStatus(done).getModificationTime() < limit and version not in pinned:
                if self.in_catalog(self._table(name, version)):
                    self.spark.sql(f"DROP TABLE {self._table(name, version)}")
                fs.delete(self._fs_path(f"{self.path(name)}/version={version}")[1], True)
                removed.append(version)
        return removed

    def base_version(self, name: str, key: str) -> int:
        """The version (0: none) that was the newest when ``key`` first asked: a replayed batch
        gets the state from before it.  Kept as an empty folder per key."""
        folder = f"{self.path(name)}/_base/{key}"
        pinned = self._children(folder, "")
        if not pinned:
            pinned = [str((self.versions(name) or [0])[-1])]
            fs, p = self._fs_path(f"{folder}/{pinned[0]}")
            fs.mkdirs(p)
        return int(pinned[0])

    def read_version(self, name: str, version: int, schema: T.StructType | None = None) -> DataFrame:
        r = self.spark.read if schema is None else self.spark.read.schema(schema)
        return r.parquet(f"{self.path(name)}/version={version}")

    # --- marks: one number per name, kept as the name of an empty folder -----------------
    def mark(self, name: str) -> int | None:
        found = self._children(self.path(name), "")
        return max(map(int, found)) if found else None

    def advance_mark(self, name: str, value: int) -> None:
        """The mark never goes back; lower ones are removed."""
        fs, p = self._fs_path(f"{self.path(name)}/{value}")
        fs.mkdirs(p)
        for old in map(int, self._children(self.path(name), "")):
            if old < self.mark(name):
                fs.delete(self._fs_path(f"{self.path(name)}/{old}")[1], True)

    def write_scratch(self, df: DataFrame, name: str) -> DataFrame:
        """A table of one load: written once, read by the load's steps, dropped after it."""
        path = f"{self.root}/_scratch/{name}"
        df.write.mode("overwrite").option("compression", CODEC).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop_scratch(self, name: str) -> None:
        fs, p = self._fs_path(f"{self.root}/_scratch/{name}")
        fs.delete(p, True)

    def read(self, name: str, schema: T.StructType | None = None) -> DataFrame:
        """Latest committed version of a rebuilt table, or all rows of an
        append-only table."""
        versions = self.versions(name)
        if versions:
            if schema is None and self.in_catalog(self._table(name, versions[-1])):
                return self.spark.table(self._table(name, versions[-1]))
            r = self.spark.read
            if schema is not None:
                r = r.schema(schema)
            return r.parquet(f"{self.path(name)}/version={versions[-1]}")
        return self.read_appends(name, schema)

    # --- append-only tables ---------------------------------------------------------
    def append_batch(self, df: DataFrame, name: str, batch_id: str | int, partition_cols: str | Sequence[str],
                     metrics: dict | None = None, rebalance: bool = True) -> dict:
        """Write one batch under ``<partition_col>=<period>/batch=<id>``.  ``metrics`` (name →
        aggregate) are taken from the rows as they are written, without a scan of their own."""
        cols = [partition_cols] if isinstance(partition_cols, str) else list(partition_cols)
        out = df.withColumn("batch", F.lit(str(batch_id)))
        if rebalance:
            # one file per period instead of one per (task, period); AQE
            # still splits a period that is too large
            out = out.hint("rebalance", *cols)
        seen = None
        if metrics:
            seen = Observation()
            out = out.observe(seen, *[m.alias(n) for n, m in metrics.items()])
        (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", CODEC)
         .partitionBy(*cols, "batch").parquet(self.path(name)))
        return seen.get if seen else {}

    def batch_periods(self, name: str, batch_id: str | int, periods: list[str] | None = None) -> list[str]:
        """Periods in which a batch has a folder; ``periods``, when the job knows them, avoids
        globbing every period directory of the table."""
        if periods is None:
            fs, p = self._fs_path(f"{self.path(name)}/*/batch={batch_id}")
            return sorted(s.getPath().getParent().getName() for s in fs.globStatus(p) or [])
        fs, _ = self._fs_path(self.path(name))
        return [d for d in periods if fs.exists(self._fs_path(f"{self.path(name)}/{d}/batch={batch_id}")[1])]

    def read_batch(self, name: str, batch_id: str | int, schema: T.StructType,
                   periods: list[str] | None = None) -> DataFrame:
        """The rows one ``append_batch`` wrote (a lineage cut: later steps of a
        job read back exactly what was committed)."""
        paths = [f"{self.path(name)}/{d}/batch={batch_id}" for d in self.batch_periods(name, batch_id, periods)]
        if not paths:
            return self.spark.createDataFrame([], schema)
        # a given schema spares the job that would look for it in the files
        return (self.spark.read.option("basePath", self.path(name)).schema(schema).parquet(*paths)
                .select(*schema.fieldNames()))

    def read_appends(self, name: str, schema: T.StructType | None = None,
                     periods: list[str] | None = None) -> DataFrame:
        """Rows of an append-only table; ``periods`` (``"<col>=<value>"``
        directory names) restricts the listing and the scan to those periods."""
        present = self._periods(name)
        if periods is not None:
            present = [d for d in present if d in set(periods)]
        if not present:
            if schema is None:
                raise FileNotFoundError(self.path(name))
            return self.spark.createDataFrame([], schema)
        r = self.spark.read.option("basePath", self.path(name))
        df = r.parquet(*[f"{self.path(name)}/{d}" for d in present])
        keep = schema.fieldNames() if schema is not None else [
            c for c in df.columns if c not in ("batch",) and c != present[0].split("=")[0]]
        return df.select(*keep)

    def read_appends_with_period(self, name: str, periods: list[str] | None = None,
                                 schema: T.StructType | None = None) -> DataFrame | None:
        """Like ``read_appends`` but keeps the period and batch columns (for pruning)."""
        present = self._periods(name)
        if periods is not None:
            present = [d for d in present if d in set(periods)]
        if not present:
            return None
        r = self.spark.read.option("basePath", self.path(name))
        df = (r if schema is None else r.schema(schema)).parquet(*[f"{self.path(name)}/{d}" for d in present])
        return df.withColumn("batch", F.col("batch").cast("string"))
