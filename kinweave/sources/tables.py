"""Keyed node tables and edge tables kept as parquet folders."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from kinweave.schemas import edge_schema


class DuplicateKeyError(ValueError):
    """A load would store the same primary key twice."""


@dataclass(frozen=True)
class NodeTable:
    name: str
    schema: StructType
    key: str


@dataclass(frozen=True)
class EdgeTable:
    name: str
    src: str
    dst: str
    props: dict[str, DataType] = field(default_factory=dict)

    @property
    def schema(self) -> StructType:
        return edge_schema(self.props)


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Columns of the schema by name, cast to its types; missing ones are NULL."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def pk_violations(df: DataFrame, key: str) -> DataFrame:
    """Keys stored more than once (or NULL), with their number of rows."""
    return (
        df.groupBy(key)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .filter((F.col("n_rows") > 1) | F.col(key).isNull())
    )


class GraphFolder:
    """A folder with one parquet table per node label and edge name.

    A table is a set of version folders ``v000001``, ``v000002``, ...; the newest
    finished one is read, so a rewrite never touches the files it reads from.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.nodes: dict[str, NodeTable] = {}
        self.edges: dict[str, EdgeTable] = {}

    def declare_node(self, name: str, schema: StructType, pk: str) -> NodeTable:
        if pk not in schema.fieldNames():
            raise ValueError(f"key {pk} is not a column of {name}")
        return self.nodes.setdefault(name, NodeTable(name, schema, pk))

    def declare_edge(
        self, name: str, src: str, dst: str, props: dict[str, DataType] | None = None
    ) -> EdgeTable:
        for label in (src, dst):
            if label not in self.nodes:
                raise ValueError(f"edge {name} uses undeclared node table {label}")
        return self.edges.setdefault(name, EdgeTable(name, src, dst, dict(props or {})))

    def _spec(self, name: str) -> NodeTable | EdgeTable:
        return self.nodes[name] if name in self.nodes else self.edges[name]

    def _versions(self, name: str) -> list[int]:
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(path):
            return []
        done = []
        for status in fs.listStatus(path):
            folder = status.getPath()
            if fs.exists(jvm.org.apache.hadoop.fs.Path(folder, "_SUCCESS")):
                done.append(int(folder.getName()[1:]))
        return sorted(done)

    def replace(self, name: str, df: DataFrame) -> DataFrame:
        """Write a new version of a table and return it as read back."""
        versions = self._versions(name)
        path = f"{self.root}/{name}/v{(versions[-1] if versions else 0) + 1:06d}"
        conform(df, self._spec(name).schema).write.mode("overwrite").parquet(path)
        return self.table(name)

    def reset(self, name: str) -> DataFrame:
        """Start the table again with no rows."""
        return self.replace(name, self.spark.createDataFrame([], self._spec(name).schema))

    def table(self, name: str, *columns: str) -> DataFrame:
        """Scan a table, projected; a table never written is empty."""
        schema = self._spec(name).schema
        versions = self._versions(name)
        if versions:
            df = self.spark.read.schema(schema).parquet(
                f"{self.root}/{name}/v{versions[-1]:06d}"
            )
        else:
            df = self.spark.createDataFrame([], schema)
        return df.select(*columns) if columns else df

    def load_nodes(self, df: DataFrame, name: str, columns: list[str] | None = None) -> DataFrame:
        """Bulk load: every key must be new and must occur once."""
        spec = self.nodes[name]
        rows = conform(df.select(*columns) if columns else df, spec.schema)
        keys = self.table(name, spec.key).unionByName(rows.select(spec.key))
        bad = pk_violations(keys, spec.key).take(1)
        if bad:
            raise DuplicateKeyError(f"{name}.{spec.key} = {bad[0][0]!r} is not unique")
        versions = self._versions(name)
        if not versions:
            return self.replace(name, rows)
        rows.write.mode("append").parquet(f"{self.root}/{name}/v{versions[-1]:06d}")
        return self.table(name)
