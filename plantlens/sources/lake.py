"""Layered Parquet tables (raw, clean, mart, lab), run log, upsert, audit.

A table is a folder of versions ``v1``, ``v2``, ...  An overwrite writes a new
version; it counts from the moment Spark commits it (``_SUCCESS``), so a write
that fails or is cut off leaves the table as it was.  The version before the
current one stays for readers that still use it, older ones are deleted.

A table that rows are merged into lies in parts.  A merge writes the parts that
it touches into the folder of the new version and then a manifest that names
the folder of every part, new or kept.  The manifest is put in place by one
rename, so a merge counts as a whole or not at all, and parts it doesn't touch
keep their files.
"""

from __future__ import annotations

import json
import logging
import re
import uuid
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage, input_bytes, together

logger = logging.getLogger(__name__)

LAYERS = ("raw", "clean", "mart", "lab")

MANIFEST = "_manifest.json"
PART = "_part"
PART_BYTES = 1 << 30        # aimed at when a table is laid out in parts by key
PART_CEILING = 10_000
CODEC = "zstd"              # tables are written once and kept, so size counts

RUN_LOG_SCHEMA = (
    "run_id string, step_name string, status string, detail string, "
    "started_at timestamp, finished_at timestamp"
)


class Lake:
    """Parquet tables under ``root/layer/table``; ``root`` must be shared storage."""

    def __init__(self, spark: SparkSession, root: str, prefix: str = ""):
        self.spark, self.root, self.prefix = spark, root.rstrip("/"), prefix

    def folder(self, layer: str, table: str) -> str:
        if layer not in LAYERS:
            raise ValueError(f"unknown layer {layer!r}")
        return f"{self.root}/{layer}/{table}"

    # -- versions ----------------------------------------------------------

    def _children(self, folder: str) -> list[str]:
        """Names in a folder of any file system that Spark reads; none if it doesn't exist."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []

    def _delete(self, folder: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def _versions(self, folder: str) -> tuple[list[int], int]:
        """Committed versions in ascending order, and the highest number in use."""
        numbers = sorted(int(n[1:]) for n in self._children(folder) if re.fullmatch(r"v\d+", n))
        done = [n for n in numbers if {"_SUCCESS", MANIFEST} & set(self._children(f"{folder}/v{n}"))]
        return done, max(numbers, default=0)

    def _manifest(self, folder: str, version: int) -> dict | None:
        """What a version in parts is made of; none for a version that is one folder."""
        if MANIFEST not in self._children(f"{folder}/v{version}"):
            return None
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/v{version}/{MANIFEST}")
        stream = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).open(path)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def manifest(self, layer: str, table: str) -> dict | None:
        """Manifest of the current version, if that lies in parts: schema, layout and folder of each part."""
        folder = self.folder(layer, table)
        done, _ = self._versions(folder)
        return self._manifest(folder, done[-1]) if done else None

    def paths(self, layer: str, table: str) -> list[str]:
        """Folders of the current version, one or one a part; none if it was never written."""
        folder = self.folder(layer, table)
        done, _ = self._versions(folder)
        if not done:
            return []
        manifest = self._manifest(folder, done[-1])
        if manifest is None:
            return [f"{folder}/v{done[-1]}"]
        return [f"{folder}/{manifest['parts'][p]}" for p in sorted(manifest["parts"], key=int)]

    def exists(self, layer: str, table: str) -> bool:
        """Whether a version was committed; a folder that can't be listed raises."""
        return bool(self._versions(self.folder(layer, table))[0])

    def read(self, layer: str, table: str) -> DataFrame:
        manifest = self.manifest(layer, table)
        if manifest is not None:
            return self._read_parts(layer, table, manifest, manifest["parts"])
        paths = self.paths(layer, table)
        return self.spark.read.parquet(*(paths or [self.folder(layer, table)]))

    def write(
        self, layer: str, table: str, df: DataFrame, *,
        mode: str = "overwrite", partition_by: Sequence[str] = (), sort_by: Sequence[str] = (),
    ) -> DataFrame:
        """Write and read back; ``overwrite`` is the full refresh.

        ``df`` may read the table itself: the new version stands beside the old.

        ``sort_by`` deals rows to tasks by ranges and orders them inside each
        file, so a range filter opens few files; it suits marts that hold too
        few rows per value for folders of their own.

        With partition columns the rows are rebalanced on them first: one task
        per value instead of every task writing every value, and AQE splits the
        values that hold too many rows.
        """
        rows = df.hint("rebalance", *partition_by) if partition_by else df
        if sort_by:
            if not partition_by:
                rows = rows.repartitionByRange(*sort_by)
            rows = rows.sortWithinPartitions(*partition_by, *sort_by)
        folder = self.folder(layer, table)
        done, highest = self._versions(folder)
        if mode == "append" and done and self._manifest(folder, done[-1]) is not None:
            raise ValueError(f"{layer}.{table} lies in parts; merge rows into it instead of appending")
        target = f"{folder}/v{done[-1]}" if mode == "append" and done else f"{folder}/v{highest + 1}"
        writer = rows.write.mode("append" if mode == "append" else "errorifexists").option("compression", CODEC)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(target)
        if mode != "append":
            self._committed(layer, table)
        return self.read(layer, table)

    def _committed(self, layer: str, table: str) -> None:
        """Drop what neither the current version nor the one before it names; renew the catalog entry."""
        folder = self.folder(layer, table)
        done, _ = self._versions(folder)
        kept: set[str] = set()
        for version in done[-2:]:
            manifest = self._manifest(folder, version)
            kept |= {f"v{version}"} if manifest is None else set(manifest["parts"].values())
        for version in done[:-2]:
            inside = [f"v{version}/parts/{n}" for n in self._children(f"{folder}/v{version}/parts")]
            unused = [n for n in inside if n not in kept]
            if f"v{version}" not in kept and len(unused) == len(inside):
                self._delete(f"{folder}/v{version}")
            else:
                for n in unused:
                    self._delete(f"{folder}/{n}")
        name = f"{self.database(layer)}.{table}"
        if self.spark.catalog.databaseExists(self.database(layer)) and self.spark.catalog.tableExists(name):
            self.register(layer, table)

    def write_all(
        self, layer: str, frames: Mapping[str, DataFrame], *,
        sort_by: Mapping[str, Sequence[str]] | None = None, parallel: int = 8,
    ) -> dict[str, DataFrame]:
        """Full refresh of several tables at once.

        The writes do not depend on each other; submitting a few together keeps
        the cluster busy while small tables and the tails of large ones finish.
        """
        def one(item):
            table, df = item
            return table, self.write(layer, table, df, sort_by=(sort_by or {}).get(table, ()))

        return dict(self._together(one, frames.items(), parallel))

    def _together(self, one: Callable, items, parallel: int) -> list:
        return together(self.spark, one, items, parallel)

    def register_all(self, tables: Sequence[tuple[str, str]], parallel: int = 8) -> list[str]:
        """Catalog entries of several (layer, table), a few at a time."""
        for layer in dict.fromkeys(layer for layer, _ in tables):
            self.create_database(layer)
        return self._together(lambda t: self.register(*t), tables, parallel)

    def append(self, layer: str, table: str, df: DataFrame) -> DataFrame:
        return self.write(layer, table, df, mode="append")

    # -- parts -----------------------------------------------------------

    def _read_parts(self, layer: str, table: str, manifest: Mapping, parts: Sequence[str]) -> DataFrame:
        schema = T.StructType.fromJson(manifest["schema"])
        paths = [f"{self.folder(layer, table)}/{manifest['parts'][p]}" for p in parts if p in manifest["parts"]]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def read_parts(self, layer: str, table: str, parts: Sequence[int]) -> DataFrame:
        """Rows of some parts; parts that don't exist have none."""
        manifest = self.manifest(layer, table)
        if manifest is None:
            raise ValueError(f"{layer}.{table} doesn't lie in parts")
        return self._read_parts(layer, table, manifest, [str(p) for p in parts])

    def merge(
        self, layer: str, table: str, updates: DataFrame, part: Column,
        combine: Callable[[DataFrame, DataFrame], DataFrame], *, layout: str = "",
    ) -> list[int]:
        """Rewrite the parts that ``updates`` has rows for, as one version; returns these parts.

        ``part`` gives the whole number of a row's part from its columns, and
        ``combine(old, new)`` the rows of the touched parts.  ``layout`` says in
        words how parts are made; a table of another layout (or of no parts) is
        rewritten whole, once.  Two writers of one version can't both succeed.
        """
        if PART in updates.columns:
            raise ValueError(f"{PART} is the name of the part")
        folder = self.folder(layer, table)
        done, highest = self._versions(folder)
        manifest = self._manifest(folder, done[-1]) if done else None
        if done:
            stored = T.StructType.fromJson(manifest["schema"]) if manifest else self.read(layer, table).schema
            updates = updates.select(*[F.col(f.name).cast(f.dataType) for f in stored])
        updates = cut_lineage(updates.withColumn(PART, part))
        touched = sorted(r[PART] for r in updates.select(PART).distinct().collect())  # at most the number of parts
        same = manifest is not None and manifest["layout"] == layout
        current = manifest["parts"] if same else {}
        if same and not touched:
            return []
        new = updates.drop(PART)
        if same:
            rows = combine(self._read_parts(layer, table, manifest, [str(p) for p in touched]), new)
        else:
            rows = combine(self.read(layer, table), new) if done else combine(new.limit(0), new)
        target = f"v{highest + 1}"
        rows = rows.select(*new.columns).withColumn(PART, part)
        rows.hint("rebalance", PART).write.option("compression", CODEC).partitionBy(PART).parquet(f"{folder}/{target}/parts")
        made = {n.removeprefix(f"{PART}="): f"{target}/parts/{n}"
                for n in self._children(f"{folder}/{target}/parts") if n.startswith(f"{PART}=")}
        kept = {p: path for p, path in current.items() if int(p) not in set(touched)}
        self._put_manifest(folder, target, {
            "layout": layout, "schema": json.loads(rows.drop(PART).schema.json()), "parts": kept | made})
        self._committed(layer, table)
        return touched if same else sorted(int(p) for p in made)

    def _put_manifest(self, folder: str, version: str, content: Mapping) -> None:
        """Write beside and rename, so that readers see all of it or nothing."""
        Path = self.spark._jvm.org.apache.hadoop.fs.Path
        target = Path(f"{folder}/{version}/{MANIFEST}")
        beside = Path(f"{folder}/{version}/_{uuid.uuid4().hex}.tmp")
        fs = target.getFileSystem(self.spark._jsc.hadoopConfiguration())
        stream = fs.create(beside, False)
        try:
            stream.write(bytearray(json.dumps(content).encode()))
        finally:
            stream.close()
        if not fs.rename(beside, target):
            raise OSError(f"{target} was not put in place")

    def upsert(
        self, layer: str, table: str, updates: DataFrame, keys: Sequence[str], *, parts: int | None = None,
    ) -> DataFrame:
        """Replace rows by key and add new ones; only parts (by key hash) with updates are rewritten.

        The first upsert lays the table out in parts of about ``PART_BYTES``,
        or in as many as asked for; later ones keep that number.
        """
        manifest = self.manifest(layer, table)
        by = f"hash of {', '.join(keys)} in "
        if parts is None and manifest is not None and manifest["layout"].startswith(by):
            parts = int(manifest["layout"].removeprefix(by))
        if parts is None:
            size = sum(input_bytes(self.spark, p) for p in self.paths(layer, table))
            parts = max(1, min(PART_CEILING, -(-size // PART_BYTES)))
        self.merge(layer, table, updates, F.pmod(F.xxhash64(*keys), F.lit(parts)),
                   lambda old, new: upsert(old, new, keys), layout=f"{by}{parts}")
        return self.read(layer, table)

    # -- catalog ---------------------------------------------------------

    def database(self, layer: str) -> str:
        return f"{self.prefix}{layer}"

    def create_database(self, layer: str) -> None:
        self.spark.sql(
            f"CREATE DATABASE IF NOT EXISTS `{self.database(layer)}` LOCATION '{self.root}/{layer}'"
        )

    def register(self, layer: str, table: str) -> str:
        """Expose a written table in the session catalog."""
        self.create_database(layer)
        name = f"`{self.database(layer)}`.`{table}`"
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        manifest = self.manifest(layer, table)
        if manifest is not None:
            self._register_parts(layer, table, name, manifest)
            return name
        current, = self.paths(layer, table)
        self.spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{current}'")
        if any(c.isPartition for c in self.spark.catalog.listColumns(name.replace("`", ""))):
            self.spark.sql(f"MSCK REPAIR TABLE {name}")
        return name

    def _register_parts(self, layer: str, table: str, name: str, manifest: Mapping) -> None:
        """A table partitioned by the part, each partition at the folder the manifest names."""
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in T.StructType.fromJson(manifest["schema"]))
        folder = self.folder(layer, table)
        self.spark.sql(f"CREATE TABLE {name} ({columns}, `{PART}` bigint) USING parquet "
                       f"PARTITIONED BY (`{PART}`) LOCATION '{folder}'")
        parts = sorted(manifest["parts"].items(), key=lambda p: int(p[0]))
        for i in range(0, len(parts), 500):  # a statement for some hundred partitions
            added = " ".join(f"PARTITION (`{PART}`={p}) LOCATION '{folder}/{path}'" for p, path in parts[i:i + 500])
            self.spark.sql(f"ALTER TABLE {name} ADD {added}")

    def tables(self) -> DataFrame:
        """Registered tables and views, sorted by layer and name (metadata only)."""
        rows = []
        for layer in LAYERS:
            if self.spark.catalog.databaseExists(self.database(layer)):
                found = self.spark.catalog.listTables(self.database(layer))
                rows += [(layer, t.name) for t in found if not t.isTemporary]
        return self.spark.createDataFrame(sorted(rows), "layer string, table_name string")

    # -- run log ---------------------------------------------------------

    def log(self, step: str, status: str, detail: Mapping) -> bool:
        """Append a run record; a failed append is logged and never fails the step itself."""
        try:
            self.append("lab", "run_log", run_record(self.spark, step, status, detail))
            return True
        except Exception:
            logger.exception("run record of %s was not written", step)
            return False


def run_record(spark: SparkSession, step: str, status: str, detail: Mapping) -> DataFrame:
    row = [(uuid.uuid4().hex, step, status, json.dumps(detail, default=str), None, None)]
    return spark.createDataFrame(row, RUN_LOG_SCHEMA).withColumns({
        "started_at": F.current_timestamp(), "finished_at": F.current_timestamp(),
    })


def upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``target`` without a new version, plus ``updates``.

    A key that occurs twice in ``updates`` fails the query, as a keyed insert
    would; the check is part of the aggregate that brings the updates together.
    """
    rest = [c for c in target.columns if c not in keys]
    grouped = updates.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), F.first(F.struct(*rest)).alias("_row")
    )
    single = F.when(F.col("_n") == 1, F.col("_row")).otherwise(
        F.raise_error(F.lit("duplicate key in updates"))
    )
    checked = grouped.select(*keys, single.alias("_row")).select(*keys, "_row.*")
    kept = target.join(updates.select(*keys), list(keys), "left_anti")
    return kept.unionByName(checked)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) of several frames in one query."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)
