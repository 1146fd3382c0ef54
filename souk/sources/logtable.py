"""A keyed table as a log of immutable deltas, for upserts and deletions that readers see whole or not at all.

``<path>/data`` holds deltas, Parquet folders of ``(key, features, gone)`` that no one changes once they are written, and
``<path>/manifest`` a small file per version that lists the deltas and prefix deletions in force, oldest first. A change writes
its delta, then its manifest under a name that must not exist yet: that rename is the commit. Of two writers one wins and
the other lists its delta behind the winner's. A reader opens one manifest, so it sees one version, whatever is written
meanwhile. A prefix deletion is an entry of the manifest and touches no data. Compaction merges deltas into one.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass

from pyspark.errors.exceptions.base import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DELTA = "key string, features map<string,string>, gone boolean"
#: Times that a writer moves behind others' commits before it gives up.
RETRIES = 20


@dataclass(frozen=True)
class Entry:
    """A delta (``path``) or the deletion of all earlier keys under ``prefix``."""

    path: str = ""
    prefix: str = ""


class LogTable:
    """The table under ``path``, in any file system that Spark reaches and that renames without overwriting."""

    def __init__(self, spark: SparkSession, path: str):
        self._spark, self._path = spark, path.rstrip("/")
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._fs = self._at("manifest").getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, *parts: str):
        return self._hadoop.Path("/".join((self._path, *parts)))

    def version(self) -> int:
        """The newest version; 0 for a table without any change."""
        folder = self._at("manifest")
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)] if self._fs.exists(folder) else []
        return max((int(n.split(".")[0]) for n in names if n.endswith(".json") and not n.startswith(".")), default=0)

    def entries(self, version: int | None = None) -> list[Entry]:
        """What a version lists, oldest first."""
        version = self.version() if version is None else version
        if not version:
            return []
        stream = self._fs.open(self._at("manifest", f"{version:012d}.json"))
        try:
            text = self._spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return [Entry(**e) for e in json.loads(text)]

    def _commit(self, change: Callable[[list[Entry]], list[Entry]]) -> int:
        """Install ``change`` of the newest list as the next version; if another writer was first, on top of that writer's."""
        for _ in range(RETRIES):
            version = self.version()
            text = json.dumps([asdict(e) for e in change(self.entries(version))])
            draft, final = self._at("drafts", uuid.uuid4().hex), self._at("manifest", f"{version + 1:012d}.json")
            stream = self._fs.create(draft)
            stream.write(bytearray(text.encode()))
            stream.close()
            self._fs.mkdirs(final.getParent())
            if not self._fs.exists(final) and self._renamed(draft, final):
                return version + 1
        raise RuntimeError(f"{RETRIES} other writers were faster")

    def _renamed(self, draft, final) -> bool:
        """Renames unless ``final`` exists; file systems tell by an error."""
        context = self._hadoop.FileContext.getFileContext(final.toUri(), self._spark._jsc.hadoopConfiguration())
        options = self._spark.sparkContext._gateway.new_array(self._spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(draft, final, options)
        except Exception as error:  # noqa: BLE001
            if "FileAlreadyExists" in str(error) or isinstance(error, PySparkException):
                return False
            raise
        return True

    def _delta(self, rows: DataFrame) -> Entry:
        name = uuid.uuid4().hex
        rows.select("key", "features", "gone").sortWithinPartitions("key").write.parquet(f"{self._path}/data/{name}")
        return Entry(path=name)

    def put(self, rows: DataFrame) -> int:
        """Replace the features of the keys of ``(key, features)`` rows; returns the version that holds them."""
        entry = self._delta(rows.filter("key is not null").withColumn("gone", F.lit(False)))
        return self._commit(lambda old: [*old, entry])

    def delete(self, keys: DataFrame) -> int:
        """Delete the keys of ``(key)`` rows."""
        entry = self._delta(keys.filter("key is not null").select("key", F.lit(None).cast("map<string,string>").alias("features"), F.lit(True).alias("gone")))
        return self._commit(lambda old: [*old, entry])

    def delete_prefix(self, prefix: str) -> int:
        """Delete every key that starts with ``prefix``; keys put later live."""
        return self._commit(lambda old: [*old, Entry(prefix=prefix)])

    def _rows(self, entries: list[Entry]) -> DataFrame:
        """Rows of all deltas with the place of their delta, less those under a later prefix deletion."""
        out = self._spark.createDataFrame([], f"{DELTA}, at int")
        for at, entry in enumerate(entries):
            if entry.path:
                rows = self._spark.read.schema(DELTA).parquet(f"{self._path}/data/{entry.path}").withColumn("at", F.lit(at))
                for later in entries[at + 1 :]:
                    if later.prefix:
                        rows = rows.filter(~F.col("key").startswith(later.prefix))
                out = out.unionByName(rows)
        return out

    @staticmethod
    def _latest(rows: DataFrame) -> DataFrame:
        """Each key's last row; of equal keys of one delta the larger features, as JSON. A deletion stays a row."""
        order = F.struct("at", F.coalesce(F.to_json("features"), F.lit("")))
        return rows.groupBy("key").agg(F.max_by(F.struct("features", "gone"), order).alias("last")).select("key", "last.*")

    def read(self, version: int | None = None) -> DataFrame:
        """``(key, features)`` of a version, the newest unless named."""
        return self._latest(self._rows(self.entries(version))).filter(~F.col("gone")).select("key", "features")

    def compact(self) -> int:
        """Merge the deltas of the present version into one; those that others add meanwhile stay behind it."""
        version = self.version()
        seen = self.entries(version)
        if not seen:
            return version
        merged = self._delta(self._latest(self._rows(seen)).filter(~F.col("gone")))

        def change(now: list[Entry]) -> list[Entry]:
            if now[: len(seen)] != seen:
                raise RuntimeError("another compaction was faster")
            return [merged, *now[len(seen) :]]

        return self._commit(change)

    def vacuum(self, keep: int = 1) -> list[str]:
        """Remove the deltas that none of the last ``keep`` versions lists, and return their names; call it when no writer is at work."""
        newest = self.version()
        used = {e.path for v in range(max(1, newest - keep + 1), newest + 1) for e in self.entries(v) if e.path}
        folder = self._at("data")
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)] if self._fs.exists(folder) else []
        unused = sorted(n for n in names if n not in used)
        for name in unused:
            self._fs.delete(self._at("data", name), True)
        return unused
