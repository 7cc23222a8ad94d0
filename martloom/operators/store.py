"""Target tables as parquet: immutable folders, and manifests that say which of them count."""

from __future__ import annotations

import json
import threading
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.operators.merge import in_ranges, key_ranges, last_per_key, merged
from martloom.session import delete, materialize, shuffles_end

MANIFESTS = "_manifest"
KEPT_MANIFESTS = 20
MAX_PARTS = 64  # folders of a table before recent ones are merged
BUCKET = "_bucket"


class TableStore:
    """Tables below ``root``; every write is a folder ``<table>/v=<n>`` of its own, never written to again.

    ``_manifest/<n>.json`` names, for all tables, the folders that count. It is put in place by one rename
    behind a finished write, so readers see a table before or after a replacement, an append or an
    upsert, never between; inside ``as_one`` the writes of several tables count from one moment
    on. Folders that no manifest names are leftovers of failed writes and are passed over.
    One writer at a time. ``keep`` is the number of replacements of a table whose folders are left after
    another one, 0 for all; it should outlast the longest reader. Tables that are upserted lie in
    folders by a hash of the key, of about ``rows_per_bucket`` rows, once they are larger than that.
    """

    def __init__(
        self, spark: SparkSession, root: str, max_rows_per_file: int = 0, keep: int = 0, rows_per_bucket: int = 1_000_000
    ):
        self.spark, self.root, self.max_rows_per_file, self.keep = spark, root.rstrip("/"), max_rows_per_file, keep
        self.rows_per_bucket = rows_per_bucket
        self._pending: dict | None = None
        self._lock = threading.Lock()

    # --- manifests --------------------------------------------------------------

    def _path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *parts]))

    def _fs(self):
        return self._path().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _manifests(self) -> list[int]:
        found = self._fs().globStatus(self._path(MANIFESTS, "*.json")) or []
        return sorted(int(s.getPath().getName().removesuffix(".json")) for s in found)

    def _tables(self) -> dict:
        """Table to its entry: ``parts`` (folders below the table), ``rows``, ``replaced`` (folders of the last
        replacements) and, once it has some, ``buckets``."""
        if self._pending is not None:
            return self._pending
        numbers = self._manifests()
        return self._manifest(numbers[-1]) if numbers else {}

    def _manifest(self, number: int) -> dict:
        stream = self._fs().open(self._path(MANIFESTS, f"{number}.json"))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _publish(self, tables: dict) -> None:
        fs, numbers = self._fs(), self._manifests()
        draft = self._path(MANIFESTS, f".draft-{uuid.uuid4().hex}")
        out = fs.create(draft, True)
        out.write(bytearray(json.dumps(tables).encode()))
        out.close()
        if not fs.rename(draft, self._path(MANIFESTS, f"{numbers[-1] + 1 if numbers else 1}.json")):
            raise RuntimeError(f"another writer published to {self.root}")
        for old in numbers[: -KEPT_MANIFESTS + 1]:
            fs.delete(self._path(MANIFESTS, f"{old}.json"), False)

    def _count(self, table: str, entry: dict) -> None:
        with self._lock:  # tables may be written side by side
            if self._pending is not None:
                self._pending[table] = entry
            else:
                self._publish({**self._tables(), table: entry})

    @contextmanager
    def as_one(self) -> Iterator[None]:
        """Writes inside the block are seen by this store at once and by others all together at its end, or not at all."""
        if self._pending is not None:
            yield
            return
        self._pending = dict(self._tables())
        try:
            yield
            tables, self._pending = self._pending, None
            before = self._tables()
            if tables != before:
                self._publish(tables)
            for table, entry in tables.items():
                if entry != before.get(table):
                    self._drop_old(table)
        finally:
            self._pending = None

    # --- reading ----------------------------------------------------------------

    def _versions(self, table: str, marker: str) -> list[int]:
        paths = [str(s.getPath()) for s in self._fs().globStatus(self._path(table, f"v=*{marker}")) or []]
        return sorted(int(p.split("/v=")[-1].split("/")[0]) for p in paths)

    def current(self, table: str) -> str | None:
        """Folder of the last replacement."""
        entry = self._tables().get(table)
        return f"{self.root}/{table}/v={entry['replaced'][-1]}" if entry else None

    def exists(self, table: str) -> bool:
        return table in self._tables()

    def rows(self, table: str) -> int:
        return self._tables().get(table, {"rows": 0})["rows"]

    def _read(self, table: str, parts: Sequence[str], schema: T.StructType) -> DataFrame:
        if not parts:
            return self.spark.createDataFrame([], schema)
        paths = [f"{self.root}/{table}/{part}" for part in parts]
        if len(paths) == 1:
            return self.spark.read.schema(schema).parquet(paths[0])
        # with the table's folder as base, v= (and a bucket) are partition columns beside the table's own
        return self.spark.read.schema(schema).option("basePath", f"{self.root}/{table}").parquet(*paths).select(*schema.names)

    def read(self, table: str, schema: T.StructType) -> DataFrame:
        entry = self._tables().get(table)
        return self._read(table, entry["parts"] if entry else [], schema)

    def read_near(self, table: str, schema: T.StructType, column: str, ranges: Sequence[tuple]) -> DataFrame:
        """Rows whose key lies in one of ``ranges``, of the folders that may hold such keys by the index of their appends."""
        entry = self._tables().get(table, {"parts": []})
        index = entry.get("keys", {}).get(column, {})

        def meets(part: str) -> bool:
            held = index.get(part)
            return held is None or any(a <= high and low <= b for a, b in held for low, high in ranges)

        return in_ranges(self._read(table, [p for p in entry["parts"] if meets(p)], schema), column, ranges)

    def _indexed(self, table: str, folder: str, column: str | None, schema: T.StructType, entry: dict) -> dict:
        """The entry with the ranges of the folder's integer keys, at most RANGES, as its index."""
        if column is None or folder not in entry["parts"]:
            return entry
        held = entry.get("keys", {}).get(column, {})
        found = {folder: key_ranges(self._read(table, [folder], schema), column)}
        index = {p: r for p, r in {**held, **found}.items() if p in entry["parts"]}
        return {**entry, "keys": {**entry.get("keys", {}), column: index}}

    # --- writing ----------------------------------------------------------------

    def replace(
        self, table: str, df: DataFrame, partition_by: Sequence[str] = (), sort_by: Sequence[str] = (), index: str | None = None
    ) -> int:
        """Write ``df`` as the table's next version; returns its row count, taken while writing."""
        folder, rows = self._write(table, df, partition_by, sort_by)
        # an empty folder says nothing, also not which partition columns there are
        entry = {"parts": [folder] if rows else [], "rows": rows, "replaced": self._replaced(table, folder)}
        self._count(table, self._indexed(table, folder, index, df.schema, entry))
        self._drop_old(table)
        return rows

    def _replaced(self, table: str, folder: str) -> list[int]:
        before = self._tables().get(table, {}).get("replaced", [])
        return [*before, int(folder.removeprefix("v="))][-max(self.keep, 1) :]

    def append(
        self, table: str, df: DataFrame, partition_by: Sequence[str] = (), sort_by: Sequence[str] = (), index: str | None = None
    ) -> int:
        """Add a folder of rows; the caller has removed rows already there. ``index`` names an integer column to index it by."""
        entry = self._tables().get(table)
        if entry is None:
            return self.replace(table, df, partition_by, sort_by, index)
        folder, rows = self._write(table, df, partition_by, sort_by)
        if rows:
            parts = [*entry["parts"], folder]
            if len(parts) > MAX_PARTS:
                # the recent half becomes one folder, so that a row is rewritten few times and lists stay short
                recent = parts[-MAX_PARTS // 2 :]
                together = self._read(table, recent, T.StructType([*df.schema]))
                folder, _ = self._write(table, together, partition_by, sort_by)
                parts = [*parts[: -MAX_PARTS // 2], folder]
            entry = {**entry, "parts": parts, "rows": entry["rows"] + rows}
            self._count(table, self._indexed(table, folder, index, df.schema, entry))
        return rows

    def upsert(
        self,
        table: str,
        source: DataFrame,
        keys: Sequence[str],
        update_columns: Sequence[str],
        schema: T.StructType,
        order_by: Sequence[str] = (),
        unique: bool = False,
    ) -> int:
        """Insert new keys, replace ``update_columns`` of known ones; the last row of a repeated key wins. Returns the table's rows.

        The source is grouped and stored once; one that is ``unique`` holds every key once and is stored already. Only buckets that hold one of its keys are read and written, once
        each; the files of all others stay. A table that outgrew its buckets, or has none yet, is written whole.
        """
        keys = list(keys)
        entry = self._tables().get(table) or {"parts": [], "rows": 0}
        incoming = source.select(*schema.names) if unique else materialize(last_per_key(source, keys, order_by).select(*schema.names), "upsert")
        wanted = max(1, -(-entry["rows"] // self.rows_per_bucket))
        buckets = entry.get("buckets", 1)
        if wanted > 2 * buckets:
            buckets = 1 << (wanted - 1).bit_length()
            read, left = entry["parts"], []
        elif buckets == 1:
            read, left = entry["parts"], []
        else:
            hit = {r[0] for r in incoming.select(self._bucket(keys, buckets)).distinct().collect()}
            read = [p for p in entry["parts"] if int(p.split(f"{BUCKET}=")[1]) in hit]
            left = [p for p in entry["parts"] if p not in read]
        seen = Observation()
        rows = merged(self._read(table, read, schema), incoming, keys, update_columns)
        counted = rows.observe(seen, F.count_if(F.col("_new")).alias("added")).drop("_new")
        if buckets == 1:
            folder, written = self._write(table, counted)
            parts = [folder] if written else []
        else:
            folder, _ = self._write(table, counted.withColumn(BUCKET, self._bucket(keys, buckets)), [BUCKET])
            where = self._fs().globStatus(self._path(table, folder, f"{BUCKET}=*")) or []
            parts = left + sorted(f"{folder}/{s.getPath().getName()}" for s in where)
        total = entry["rows"] + seen.get["added"]
        replaced = self._tables().get(table, {}).get("replaced", []) if left else self._replaced(table, folder)
        self._count(table, {"parts": parts, "rows": total, "replaced": replaced, "buckets": buckets})
        self._drop_old(table)
        return total

    @staticmethod
    def _bucket(keys: Sequence[str], buckets: int):
        return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")

    def _drop_old(self, table: str) -> None:
        if not self.keep or self._pending is not None:
            return
        entry = self._tables()[table]
        for old in self._versions(table, ""):
            if old < entry["replaced"][0]:
                delete(self.spark, f"{self.root}/{table}/v={old}")
        if entry.get("buckets", 1) > 1:  # bucket folders that later ones took the place of
            named = {p for n in self._manifests() for p in self._manifest(n).get(table, {}).get("parts", [])}
            for s in self._fs().globStatus(self._path(table, "v=*", f"{BUCKET}=*")) or []:
                if f"{s.getPath().getParent().getName()}/{s.getPath().getName()}" not in named:
                    self._fs().delete(s.getPath(), True)

    def _write(
        self, table: str, df: DataFrame, partition_by: Sequence[str] = (), sort_by: Sequence[str] = ()
    ) -> tuple[str, int]:
        """Write a folder that nothing names yet; returns it and its row count."""
        started = self._versions(table, "")
        folder = f"v={(started[-1] if started else 0) + 1}"
        seen = Observation()
        if partition_by:
            # adaptive execution then cuts a large partition value over many tasks and
            # packs small ones, instead of one file per task and value
            df = df.hint("rebalance", *partition_by)
        if sort_by:
            # narrow key ranges per row group, which later reads by key range skip by
            df = df.sortWithinPartitions(*partition_by, *sort_by)
        writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("errorifexists")
        if self.max_rows_per_file:
            writer = writer.option("maxRecordsPerFile", self.max_rows_per_file)
        with shuffles_end(df.sparkSession):
            writer.partitionBy(*partition_by).parquet(f"{self.root}/{table}/{folder}")
        return folder, seen.get["rows"]
