"""Daily sink that stays small: a manifest per day, and compaction of what batches have left.

Layout below ``path``:

* ``data/<day>/delta-<batch>`` - the rows a micro-batch wrote for that day;
* ``data/<day>/base-<batch>`` - the newest row per key of everything before that batch;
* ``manifest/<day>/<version>.json`` - the live folders of the day; the highest
  version counts, and a version appears whole, by a rename;
* ``last.json`` - the days of the batch being written.

A batch writes its delta, then a manifest that names it.  Once a day has
``max_deltas`` older deltas, they and the base become a new base, and another
manifest swaps it in.  Only earlier batches are compacted: these are committed
and never replayed.  So a batch that is replayed after a crash between any two
steps replaces exactly what its first attempt left.  Readers see the folders of
one manifest, at most ``max_deltas`` + 2 per day; folders that neither of the
newest two manifests names are deleted.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.schema import DAILY_INDEX_PREFIX
from tidemark.streaming.sinks import BATCH_COL, daily_partitions

DAY_COL = "index_name"
MAX_DELTAS = 8
ROWS_PER_FILE = 1_000_000


class Folder:
    """The few file-system steps the sink needs, on whatever storage the path names."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._make = spark._jvm.org.apache.hadoop.fs.Path
        self.fs = self._make(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def at(self, name: str):
        return self._make(f"{self.path}/{name}")

    def names(self, name: str) -> list[str]:
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self.at(name))) if self.fs.exists(self.at(name)) else []

    def read(self, name: str) -> dict | None:
        if not self.fs.exists(self.at(name)):
            return None
        rows = self.spark.read.text(f"{self.path}/{name}", wholetext=True).collect()
        return json.loads(rows[0][0]) if rows else None

    def write(self, name: str, value: dict) -> None:
        """Write aside, then rename: readers see the old file or the new one."""
        aside = self.at(f"{name}.tmp")
        out = self.fs.create(aside, True)
        out.write(bytearray(json.dumps(value).encode()))
        out.close()
        if self.fs.exists(self.at(name)):
            self.fs.delete(self.at(name), False)
        if not self.fs.rename(aside, self.at(name)):
            raise OSError(f"could not rename {name}")

    def delete(self, name: str) -> None:
        self.fs.delete(self.at(name), True)


def _version(name: str) -> int:
    return int(name.removesuffix(".json"))


def _manifest(folder: Folder, day: str) -> tuple[int, list[str]]:
    """Newest version and its live folders (version 0: none)."""
    versions = [n for n in folder.names(f"manifest/{day}") if n.endswith(".json")]
    if not versions:
        return 0, []
    newest = max(versions, key=_version)
    return _version(newest), folder.read(f"manifest/{day}/{newest}")["folders"]


def _batch(name: str) -> int:
    return int(name.split("-")[1])


def newest_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The row of the latest batch per key; a key has one row per live folder at most."""
    latest = Window.partitionBy(*keys).orderBy(F.col(BATCH_COL).desc())
    return df.withColumn("__rn", F.row_number().over(latest)).where("__rn = 1").drop("__rn")


class CompactingDailySink:
    """Writer for the streams' ``writer=``: daily folders, newest row per key, compacted.

    ``key_cols`` say which rows replace each other within a day; the day comes from
    ``time_col`` or, without one, from the processing clock.
    """

    def __init__(self, key_cols: Sequence[str], time_col: str | None = None, prefix: str = DAILY_INDEX_PREFIX,
                 max_deltas: int = MAX_DELTAS, rows_per_file: int = ROWS_PER_FILE):
        self.keys, self.time_col, self.prefix = list(key_cols), time_col, prefix
        self.max_deltas, self.rows_per_file = max_deltas, rows_per_file

    def __call__(self, df: DataFrame, path: str, batch_id: int) -> None:
        spark = df.sparkSession
        folder = Folder(spark, path)
        rows = daily_partitions(df, self.time_col, self.prefix).withColumn(BATCH_COL, F.lit(batch_id).cast("long"))
        staged = f"{folder.path}/incoming"
        rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(DAY_COL).parquet(staged)
        days = [n.split("=", 1)[1] for n in folder.names("incoming") if n.startswith(f"{DAY_COL}=")]
        before = folder.read("last.json") or {}
        gone = set(before["days"]) - set(days) if before.get("batch") == batch_id else set()
        folder.write("last.json", {"batch": batch_id, "days": sorted({*days, *gone})})
        for day in sorted(gone):  # a first attempt wrote this day, the replay doesn't
            version, live = _manifest(folder, day)
            self._swap(folder, day, version, [f for f in live if f != f"delta-{batch_id}"])
        for day in days:
            self._take(folder, day, batch_id)

    def _take(self, folder: Folder, day: str, batch_id: int) -> None:
        delta = f"delta-{batch_id}"
        folder.delete(f"data/{day}/{delta}")
        folder.fs.mkdirs(folder.at(f"data/{day}"))
        if not folder.fs.rename(folder.at(f"incoming/{DAY_COL}={day}"), folder.at(f"data/{day}/{delta}")):
            raise OSError(f"could not take {day}")
        version, live = _manifest(folder, day)
        live = [f for f in live if f != delta] + [delta]
        version = self._swap(folder, day, version, live)
        older = [f for f in live if _batch(f) < batch_id or f.startswith("base")]
        if sum(f.startswith("delta") for f in older) >= self.max_deltas:
            base = f"base-{batch_id}"
            self._compact(folder, day, older, base)
            self._swap(folder, day, version, [base, delta])

    def _compact(self, folder: Folder, day: str, live: list[str], base: str) -> None:
        rows = newest_per_key(_read(folder, day, live), self.keys)
        total = sum(_read(folder, day, [f]).count() for f in live)  # from file footers
        (rows.repartition(1 + total // self.rows_per_file, *self.keys)
         .write.mode("overwrite").parquet(f"{folder.path}/data/{day}/{base}"))

    def _swap(self, folder: Folder, day: str, version: int, live: list[str]) -> int:
        folder.write(f"manifest/{day}/{version + 1}.json", {"folders": live})
        kept = set(live)
        for name in folder.names(f"manifest/{day}"):
            if name.endswith(".json") and _version(name) == version:
                kept |= set((folder.read(f"manifest/{day}/{name}") or {"folders": []})["folders"])
            elif name.endswith(".json") and _version(name) < version:
                folder.delete(f"manifest/{day}/{name}")
        for name in folder.names(f"data/{day}"):
            if name not in kept and _batch(name) <= max(map(_batch, live), default=0):
                folder.delete(f"data/{day}/{name}")
        return version + 1


def _read(folder: Folder, day: str, live: Sequence[str]) -> DataFrame:
    return folder.spark.read.option("mergeSchema", "true").parquet(*[f"{folder.path}/data/{day}/{f}" for f in live])


def days(spark: SparkSession, path: str) -> list[str]:
    return Folder(spark, path).names("manifest")


def read_daily(spark: SparkSession, path: str, key_cols: Sequence[str], only: Sequence[str] | None = None) -> DataFrame:
    """Newest row per key of the given days (default: all), with ``index_name``; reads live folders only.

    Raises if no day has rows, as reading an empty folder does.
    """
    folder = Folder(spark, path)
    out = None
    for day in only if only is not None else folder.names("manifest"):
        live = _manifest(folder, day)[1]
        if live:
            rows = newest_per_key(_read(folder, day, live), key_cols).withColumn(DAY_COL, F.lit(day)).drop(BATCH_COL)
            out = rows if out is None else out.unionByName(rows)
    if out is None:
        raise FileNotFoundError(f"no rows below {path}")
    return out
