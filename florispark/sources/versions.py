"""Tables of immutable files in versions: a change rewrites the files that hold a hit key, and a new version appears at once or not at all.

A table is a folder: `data/` has files, which are never changed; `manifests/` has a list of files for each
version; `versions/N` names the manifest of version N and is made in one step that fails if N is there.
Readers hold one version's files, so they aren't disturbed; vacuum() removes what no kept version has.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


class CheckFailed(ValueError):
    """What was written breaks a rule; no version has it."""


class Conflict(RuntimeError):
    """Someone else has made the version that this change would have been."""


def _name(file: str) -> str:
    """Folder and name of a file: what is before may be written in more than one way."""
    return "/".join(file.rsplit("/", 2)[-2:])


class VersionedTable:
    """Keyed updates by copying files; the driver sees file names only, as Spark's own file listing does."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    # ---- files ----------------------------------------------------------------------------------

    def _at(self, *parts: str):
        where = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path("/".join([self.path, *parts]))
        return where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), where

    def _put(self, text: str, *parts: str) -> None:
        fs, where = self._at(*parts)
        fs.mkdirs(where.getParent())
        out = fs.create(where, False)  # fails where there is such a file
        out.write(bytearray(text.encode()))
        out.close()

    def _get(self, *parts: str) -> str:
        fs, where = self._at(*parts)
        stream = fs.open(where)
        try:
            return self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def versions(self) -> dict[int, float]:
        """Numbers of the versions and the times (seconds) at which they were made; one that is still being made isn't there."""
        fs, where = self._at("versions")
        if not fs.exists(where):
            return {}
        return {int(s.getPath().getName()): s.getModificationTime() / 1000 for s in fs.listStatus(where) if s.getLen() and s.getPath().getName().isdigit()}

    def version(self) -> int | None:
        return max(self.versions(), default=None)

    def _manifest(self, version: int | None) -> dict:
        if version is None:
            raise FileNotFoundError(f"{self.path} has no version")
        return json.loads(self._get("manifests", self._get("versions", str(version)).strip()))

    def files(self, version: int | None = None) -> list[str]:
        return self._manifest(self.version() if version is None else version)["files"]

    # ---- reading --------------------------------------------------------------------------------

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version, the newest if none is given."""
        m = self._manifest(self.version() if version is None else version)
        return self._rows(m["files"], m["schema"])

    def _rows(self, files: Sequence[str], schema: str) -> DataFrame:
        kind = StructType.fromJson(json.loads(schema))
        return self.spark.read.schema(kind).parquet(*files) if files else self.spark.createDataFrame([], kind)

    # ---- changing -------------------------------------------------------------------------------

    def _write(self, df: DataFrame, cluster: Sequence[str] = (), observation: Observation | None = None, metrics: Sequence[Column] = ()) -> list[str]:
        folder, schema = f"{self.path}/data/{uuid.uuid4().hex}", df.schema
        # keys that are near each other in few files, so that few files are hit
        df = df.repartitionByRange(*cluster).sortWithinPartitions(*cluster) if cluster else df
        # behind the exchange, as ranges are found by a run of their own
        (df.observe(observation, *metrics) if observation else df).write.parquet(folder)
        return sorted(self.spark.read.schema(schema).parquet(folder).inputFiles())

    def _commit(self, before: int | None, files: Sequence[str], schema: StructType, batches: dict[str, int] | None = None) -> int:
        number, name = (0 if before is None else before + 1), f"{uuid.uuid4().hex}.json"
        self._put(json.dumps({"schema": schema.json(), "files": list(files), "batches": batches or {}}), "manifests", name)
        try:
            self._put(name, "versions", str(number))
        except Exception as e:
            if "exists" in str(e).lower():
                raise Conflict(f"{self.path}: version {number} is there already") from e
            raise
        return number

    def replace(self, df: DataFrame, cluster: Sequence[str] = ()) -> int:
        """All rows anew, dealt to files by ranges of the cluster columns; the number of the version."""
        before = self.version()
        return self._commit(before, self._write(df, cluster), df.schema)

    def replace_checked(self, df: DataFrame, checks: dict[str, tuple[Column, Callable[[object], bool]]], cluster: Sequence[str] = ()) -> dict[str, tuple[bool, object]]:
        """As replace(), if all checks hold: each an aggregate and a test of its value, all of them taken in the pass that writes.

        (ok, value) by label; where one fails, CheckFailed is raised and the table stays as it was.
        """
        before, seen = self.version(), Observation()
        files = self._write(df, cluster, seen, [agg.alias(label) for label, (agg, _) in checks.items()])
        got = seen.get
        out = {label: (bool(test(got[label])), got[label]) for label, (_, test) in checks.items()}
        failed = {label: value for label, (ok, value) in out.items() if not ok}
        if failed:
            fs, where = self._at("data", files[0].rsplit("/", 2)[-2]) if files else (None, None)
            if fs is not None:
                fs.delete(where, True)
            raise CheckFailed(", ".join(f"{label}: {value}" for label, value in failed.items()))
        self._commit(before, files, df.schema)
        return out

    def append(self, df: DataFrame, cluster: Sequence[str] = (), batch: tuple[str, int] | None = None) -> int:
        """More rows; of a stream's batch, (its name, its number), that a version has already, nothing."""
        before = self.version()
        m = self._manifest(before) if before is not None else {"files": [], "schema": df.schema.json()}
        batches = dict(m.get("batches", {}))
        if batch is not None:
            if batches.get(batch[0], -1) >= batch[1]:
                return before
            batches[batch[0]] = batch[1]
        kind = StructType.fromJson(json.loads(m["schema"]))
        return self._commit(before, [*m["files"], *self._write(df.select(*kind.names), cluster)], kind, batches)

    def _hit(self, rows: DataFrame, keys: DataFrame, key: str) -> list[str]:
        """Files with a row whose key is among keys: only the key column is read."""
        found = rows.select(F.col(key).alias("_key"), F.col("_metadata.file_path").alias("_file")).join(keys.select(F.col(key).alias("_key")).distinct(), "_key", "left_semi")
        return [_name(r["_file"]) for r in found.select("_file").distinct().collect()]  # names of files

    def _rewrite(self, keys: DataFrame, key: str, change, new: DataFrame | None = None) -> dict:
        before = self.version()
        m = self._manifest(before)
        kind = StructType.fromJson(json.loads(m["schema"]))
        rows = self._rows(m["files"], m["schema"])
        names = set(self._hit(rows, keys, key)) if m["files"] else set()
        hit = {f for f in m["files"] if _name(f) in names}
        stay = [f for f in m["files"] if f not in hit]
        if not hit and new is None:
            return {"version": before, "rewritten": 0, "kept": len(stay)}
        made = self._write(change(self._rows(sorted(hit), m["schema"])).select(*kind.names)) if hit else []
        added = self._write(new.select(*kind.names)) if new is not None else []
        number = self._commit(before, [*stay, *made, *added], kind, m.get("batches"))
        return {"version": number, "rewritten": len(hit), "kept": len(stay)}

    def update(self, keys: DataFrame, key: str, values: dict[str, Column]) -> dict:
        """UPDATE ... SET ... WHERE key IN (keys): values are expressions over the row as it was, and over the columns of keys, named _new_*.

        keys has one row for each key.  Rows with a null key are never hit.
        """
        return self._rewrite(keys, key, lambda rows: self._set(rows, keys, key, values))

    @staticmethod
    def _set(rows: DataFrame, keys: DataFrame, key: str, values: dict[str, Column]) -> DataFrame:
        other = keys.select(F.col(key).alias("_new_key"), *(F.col(c).alias(f"_new_{c}") for c in keys.columns if c != key), F.lit(True).alias("_hit"))
        j = rows.join(other, F.col(key) == F.col("_new_key"), "left")
        return j.select(*(F.when(F.col("_hit"), values[c]).otherwise(F.col(c)).alias(c) if c in values else F.col(c) for c in rows.columns))

    def delete(self, keys: DataFrame, key: str) -> dict:
        """DELETE ... WHERE key IN (keys)."""
        return self._rewrite(keys, key, lambda rows: rows.join(keys.select(key).distinct(), key, "left_anti"))

    def upsert(self, new: DataFrame, key: str) -> dict:
        """Rows of new in place of those with their key, and beside the others where there is none; new has one row for each key."""
        before = self.read()
        values = {c: F.col(f"_new_{c}") for c in new.columns if c != key}
        more = new.join(before.select(key), key, "left_anti")
        return self._rewrite(new, key, lambda rows: self._set(rows, new, key, values), None if more.isEmpty() else more)

    def vacuum(self, keep: int = 2) -> int:
        """Removes the versions before the last `keep`, and folders of data that no version has; how many versions went."""
        numbers = sorted(self.versions())
        old, held = numbers[:-keep], {f.rsplit("/", 2)[-2] for n in numbers[-keep:] for f in self.files(n)}
        for n in old:
            fs, where = self._at("manifests", self._get("versions", str(n)).strip())
            fs.delete(where, False)
            fs.delete(self._at("versions", str(n))[1], False)
        fs, where = self._at("data")
        for s in fs.listStatus(where) if fs.exists(where) else []:
            if s.getPath().getName() not in held and time.time() - s.getModificationTime() / 1000 > 3600:  # else it may belong to a change under way
                fs.delete(s.getPath(), True)
        return len(old)
