"""Keyed tables in buckets, with a manifest for each version."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructType

from kinweave.operators.keys import last_wins
from kinweave.session import materialise
from kinweave.sources.tables import DuplicateKeyError, conform

BUCKETS = 16
# A batch up to so many rows is sent to the stored rows; they stay where they are.
SMALL_BATCH = 200_000
# Parts a bucket may be spread over before a load puts it together again.
MOST_PARTS = 8
MANIFEST = "bucket int, parts array<long>"


@dataclass(frozen=True)
class KeyedTable:
    name: str
    schema: StructType
    key: tuple[str, ...]
    buckets: int


class KeyedStore:
    """A folder of tables with a unique key, cut into buckets by a hash of the key.

    A write puts the rows of the buckets it touches into a part of its own,
    ``data/part=<n>/bucket=<b>``; a version is a manifest that names the parts of each bucket.
    Writing the manifest is the last thing a write does: if it fails before, the old version
    stays as it is. Only the buckets of a batch are read, and only they are written; the files
    of all others go over into the next version. One writer at a time is assumed.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.tables: dict[str, KeyedTable] = {}

    def declare(
        self, name: str, schema: StructType, key: str | list[str], buckets: int = BUCKETS
    ) -> KeyedTable:
        """Name a table; the number of buckets must stay the same while it has rows."""
        columns = (key,) if isinstance(key, str) else tuple(key)
        for column in columns:
            if column not in schema.fieldNames():
                raise ValueError(f"key {column} is not a column of {name}")
        return self.tables.setdefault(name, KeyedTable(name, schema, columns, buckets))

    def _versions(self, name: str) -> list[int]:
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}/manifests")
        fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(path):
            return []
        folders = [status.getPath() for status in fs.listStatus(path)]
        done = [p for p in folders if fs.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
        return sorted(int(p.getName()[1:]) for p in done)

    def manifest(self, name: str, version: int | None = None) -> dict[int, list[int]]:
        """The parts of each bucket that has rows, in the newest or a given version."""
        versions = self._versions(name)
        if not versions:
            return {}
        path = f"{self.root}/{name}/manifests/v{version or versions[-1]:06d}"
        rows = self.spark.read.schema(MANIFEST).parquet(path).collect()  # one row per bucket
        return {r["bucket"]: list(r["parts"]) for r in rows}

    def _commit(self, name: str, parts: dict[int, list[int]]) -> None:
        versions = self._versions(name)
        path = f"{self.root}/{name}/manifests/v{(versions[-1] if versions else 0) + 1:06d}"
        rows = self.spark.createDataFrame(sorted(parts.items()), MANIFEST)
        rows.coalesce(1).write.mode("overwrite").parquet(path)

    def _read(self, spec: KeyedTable, parts: dict[int, list[int]]) -> DataFrame:
        base = f"{self.root}/{spec.name}/data"
        paths = [f"{base}/part={p}/bucket={b}" for b in sorted(parts) for p in parts[b]]
        if not paths:
            return self.spark.createDataFrame([], spec.schema)
        whole = StructType([*spec.schema.fields]).add("part", LongType()).add("bucket", IntegerType())
        rows = self.spark.read.schema(whole).option("basePath", base).parquet(*paths)
        return rows.select(*spec.schema.fieldNames())

    def table(self, name: str, *columns: str, version: int | None = None) -> DataFrame:
        """Scan the newest or a given version; a table never written is empty."""
        rows = self._read(self.tables[name], self.manifest(name, version))
        return rows.select(*columns) if columns else rows

    def bucket_of(self, name: str) -> Column:
        spec = self.tables[name]
        return F.pmod(F.xxhash64(*spec.key), F.lit(spec.buckets)).cast("int")

    def _write(self, spec: KeyedTable, rows: DataFrame, part: int) -> None:
        (
            rows.withColumn("bucket", self.bucket_of(spec.name))
            .repartition("bucket")
            .sortWithinPartitions("bucket", *spec.key)
            .write.mode("overwrite")
            .partitionBy("bucket")
            .parquet(f"{self.root}/{spec.name}/data/part={part}")
        )

    def _next_part(self, name: str) -> int:
        """A number no version has used; a part that a failed write left is overwritten."""
        versions = self._versions(name)
        return (versions[-1] if versions else 0) + 1

    def _matched(self, spec: KeyedTable, stored: DataFrame, keys: DataFrame, small: bool) -> DataFrame:
        """The keys of the batch that are stored. A small batch is sent to the stored rows."""
        return stored.select(*spec.key).join(
            F.broadcast(keys) if small else keys, list(spec.key), "left_semi"
        )

    def _touched(self, name: str, batch: DataFrame) -> list[int]:
        return [r[0] for r in batch.select(self.bucket_of(name)).distinct().collect()]

    def load(self, name: str, df: DataFrame, small_batch: int = SMALL_BATCH) -> DataFrame:
        """Add rows whose keys are new and occur once, else fail and change nothing.

        The batch is checked by itself; of the stored rows only the keys of its buckets are
        looked at. New rows become a part beside those of their buckets, which are put together
        if there are more than a few.
        """
        spec = self.tables[name]
        batch = materialise(conform(df, spec.schema), "batch")
        null = F.lit(False)
        for column in spec.key:
            null = null | F.col(column).isNull()
        bad = (
            batch.groupBy(*spec.key)
            .agg(F.count(F.lit(1)).alias("_n"))
            .filter((F.col("_n") > 1) | null)
            .take(1)
        )
        manifest, n = self.manifest(name), batch.count()
        touched = self._touched(name, batch)
        old = {b: manifest[b] for b in touched if b in manifest}
        if not bad and old:
            keys = batch.select(*spec.key)
            bad = self._matched(spec, self._read(spec, old), keys, n <= small_batch).take(1)
        if bad:
            values = ", ".join(repr(v) for v in list(bad[0])[: len(spec.key)])
            raise DuplicateKeyError(f"{name}: key {values} is not unique")
        part = self._next_part(name)
        full = {b: parts for b, parts in old.items() if len(parts) >= MOST_PARTS}
        rows = batch.unionByName(self._read(spec, full)) if full else batch
        if n:
            self._write(spec, rows, part)
        new = {b: [part] if b in full else [*old.get(b, []), part] for b in touched}
        self._commit(name, {**manifest, **new})
        return self.table(name)

    def merge(
        self,
        name: str,
        incoming: DataFrame,
        set_cols: list[str],
        order: Column | str | None = None,
        small_batch: int = SMALL_BATCH,
    ) -> DataFrame:
        """Create or update rows by key, in the buckets of the batch alone.

        Of several rows with one key the last in ``order`` wins (by default that of the values);
        ``set_cols`` overwrite, also with NULL, other columns stay. Rows with a NULL in the key
        are left out. A batch of checked small size is sent to the stored rows, which are then
        neither shuffled nor sorted before they are written again; a larger one meets them by a
        shuffle of its buckets.
        """
        spec = self.tables[name]
        key = list(spec.key)
        rows = incoming.dropna(subset=key)
        by = F.struct(*set_cols) if order is None and set_cols else F.lit(1) if order is None else order
        names = [*key, *set_cols]
        kinds = [spec.schema[c].dataType for c in names]
        batch = last_wins(rows, key, set_cols, by).select(
            *[F.col(c).cast(kind).alias(c) for c, kind in zip(names, kinds)]
        )
        batch = materialise(batch, "batch")
        manifest, n = self.manifest(name), batch.count()
        if not n:
            return self.table(name)
        touched = self._touched(name, batch)
        stored = self._read(spec, {b: manifest[b] for b in touched if b in manifest})
        updated, matched = self.plan_merge(spec, stored, batch, set_cols, n <= small_batch)
        found = materialise(matched, "matched")  # of the batch's size at most
        fresh = conform(batch.join(found, key, "left_anti"), spec.schema)
        part = self._next_part(name)
        self._write(spec, updated.unionByName(fresh), part)
        self._commit(name, {**manifest, **{b: [part] for b in touched}})
        return self.table(name)

    def plan_merge(
        self, spec: KeyedTable, stored: DataFrame, batch: DataFrame, set_cols: list[str], small: bool
    ) -> tuple[DataFrame, DataFrame]:
        """The stored rows with the values of the batch, and the keys of the batch among them."""
        key = list(spec.key)
        new = batch.select(
            *key, F.lit(True).alias("_hit"), *[F.col(c).alias(f"_new_{c}") for c in set_cols]
        )
        joined = stored.join(F.broadcast(new) if small else new, key, "left")
        updated = joined.select(
            *[
                (
                    F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)) if c in set_cols else F.col(c)
                ).alias(c)
                for c in spec.schema.fieldNames()
            ]
        )
        return updated, self._matched(spec, stored, batch.select(*key), small)

    def files(self, name: str, version: int | None = None) -> dict[int, list[str]]:
        """The files of each bucket in a version."""
        spec, parts = self.tables[name], self.manifest(name, version)
        return {b: sorted(self._read(spec, {b: parts[b]}).inputFiles()) for b in parts}
