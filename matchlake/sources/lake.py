"""Parquet tables of the lake: typed reads, partition-wise and full writes."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.schemas import BRONZE, GOLD, SILVER
from matchlake.sources.versions import SnapshotTable


def read_table(spark: SparkSession, path: str, schema: str, **options: str) -> DataFrame | None:
    """The parquet table at `path`, or None when nothing is stored there."""
    try:
        return spark.read.options(**options).schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def read_or_empty(spark: SparkSession, path: str, schema: str, **options: str) -> DataFrame:
    """The parquet table at `path`; an empty one of the same type when it does not exist yet."""
    found = read_table(spark, path, schema, **options)
    return spark.createDataFrame([], schema) if found is None else found


class Lake:
    """The three layers under one root: raw envelopes, typed tables, features and monitoring."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"

    def bronze(self, table: str, inner_date: bool = False) -> DataFrame:
        """Raw envelopes. Folders named date=... give the `date` column.

        `inner_date` reads a `date` column stored inside the files instead of the folder name.
        """
        options = {"recursiveFileLookup": "true"} if inner_date else {}
        return read_or_empty(self.spark, self.path("bronze", table), BRONZE[table], **options)

    def snapshots(self, layer: str, table: str, partition_by: str | None = None, tracked: Iterable[str] = ()) -> SnapshotTable:
        """A table that is kept in versions."""
        schema = {"silver": SILVER, "gold": GOLD}[layer][table]
        return SnapshotTable(self.spark, self.path(layer, table), schema, partition_by, list(tracked))

    def _stored(self, layer: str, table: str, schema: str, partition_by: str | None = None) -> DataFrame | None:
        """The newest version of a table, or its plain files; None when nothing is stored."""
        versioned = SnapshotTable(self.spark, self.path(layer, table), schema, partition_by)
        newest = versioned.snapshot()
        if newest is not None:
            partitioned = any("/" in folder for folder in newest.parts.values())
            versioned.partition_by = partition_by if partitioned else None
            found, declared = versioned.read(newest), [field.split()[0] for field in schema.split(", ")]
            return found.select(*declared, *([partition_by] if versioned.partition_by else []))
        return read_table(self.spark, self.path(layer, table), schema)

    def silver(self, table: str) -> DataFrame:
        found = self._stored("silver", table, SILVER[table])
        return self.spark.createDataFrame([], SILVER[table]) if found is None else found

    def gold(self, table: str, partition_by: str | None = None) -> DataFrame:
        """A table of the feature layer; with `partition_by` that column too, as the last one."""
        found = self._stored("gold", table, GOLD[table], partition_by)
        if found is None:
            found = self.spark.createDataFrame([], GOLD[table])
        fields = [field.split()[0] for field in GOLD[table].split(", ")]
        return found.select(*fields, *([partition_by] if partition_by in found.columns else []))

    def store(self, df: DataFrame, layer: str, table: str, partition_by: str | None = None) -> DataFrame:
        """Rebuild a table and continue from the stored rows.

        Readers see the old table until the new one is complete, and then the new one, whenever the writer is lost.
        """
        kinds = ", ".join(f"`{c}` {kind}" for c, kind in df.dtypes if c != partition_by)
        versioned = SnapshotTable(self.spark, self.path(layer, table), kinds, partition_by)
        return versioned.read(versioned.rebuild(df)).select(*df.columns)

    def register_views(self, layer: str, prefix: str = "") -> list[str]:
        """Temporary views over the stored tables of a layer; absent tables get none."""
        schemas = {"bronze": BRONZE, "silver": SILVER, "gold": GOLD}[layer]
        registered = []
        for table, schema in schemas.items():
            stored = self._stored(layer, table, schema)
            if stored is not None:
                stored.createOrReplaceTempView(prefix + table)
                registered.append(prefix + table)
        return registered


def replace_partitions(df: DataFrame, path: str, column: str = "date") -> None:
    """Replace only the partitions `df` has rows for; an empty `df` changes nothing.

    The rebalance hint gathers each partition into few files and lets AQE split a large one.
    """
    (
        df.hint("rebalance", column)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(column)
        .parquet(path)
    )


def drop_partitions(spark: SparkSession, path: str, values: Iterable[str], column: str = "date") -> None:
    """Delete the named partitions of a table; absent ones do no harm."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    for value in values:
        folder = hadoop.Path(f"{path}/{column}={value}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count of each table."""
    counts: Iterable[DataFrame] = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def json_records(df: DataFrame) -> DataFrame:
    """One JSON object per row with every field present: NULL and NaN as null, times in ISO form."""
    clean = [
        F.when(~F.isnan(c), F.col(c)).alias(c) if kind in ("double", "float") else F.col(c)
        for c, kind in df.dtypes
    ]
    options = {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ssxxx"}
    return df.select(F.to_json(F.struct(*clean), options).alias("record"))
