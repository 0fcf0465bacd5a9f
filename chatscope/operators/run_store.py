"""A durable registry of run configurations (M5): find a run's slot, or assign and store one.

The registry is a versioned table in a shared folder:

* ``data/<name>/``: Parquet ``(run_id, config)``, written by Spark; never changed.
* ``versions/<number>.json``: names the folder that a version adds, or, every ``WHOLE_EVERY`` versions, one that holds
  the whole table. A version becomes visible by creating its file if there is none, so it belongs to one writer only.

``register`` reads a version, matches the requests against it, writes the new configurations and publishes them as the
next version. If another writer was faster, nothing of its own is visible; it matches again against the new version and
tries once more. So concurrent callers get different slots for different configurations and one slot for equal ones, and
a caller that fails half-way leaves only a folder that no version names.

Publishing needs a file system that creates or renames a file only where none is: local ones (a hard link)
and HDFS (a rename) do. Object stores without such an operation are not safe for concurrent writers.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatscope.operators.registry import match_registry
from chatscope.operators.sampling import consecutive_index
from chatscope.session import materialize

WHOLE_EVERY = 16
ATTEMPTS = 100
_DIGITS = 12


class RunStore:
    """The registry in the folder ``path``; its first writer creates it."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    # -------------------------------------------------------------- files
    def _at(self, name: str):
        sc = self.spark.sparkContext
        p = sc._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return p, p.getFileSystem(sc._jsc.hadoopConfiguration())

    def _file(self, version: int) -> str:
        return f"versions/{version:0{_DIGITS}d}.json"

    def _publish(self, version: int, content: dict) -> bool:
        """Creates the version's file; False if there is one already."""
        jvm = self.spark.sparkContext._jvm
        target, fs = self._at(self._file(version))
        own, _ = self._at(f"versions/.{uuid.uuid4().hex}")
        out = fs.create(own, False)
        out.write(bytearray(json.dumps(content).encode()))
        out.close()
        try:
            if fs.getUri().getScheme() == "file":  # a rename would replace the file
                os.link(own.toUri().getPath(), target.toUri().getPath())
                return True
            none = jvm.org.apache.hadoop.fs.Options.Rename.NONE
            options = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
            options[0] = none
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), self.spark.sparkContext._jsc.hadoopConfiguration()
                                                                ).rename(own, target, options)
            return True
        except FileExistsError:
            return False
        except Exception:
            if fs.exists(target):
                return False
            raise
        finally:
            fs.delete(own, False)

    def version(self) -> int:
        """The newest version; 0 if nothing is stored."""
        folder, fs = self._at("versions")
        if not fs.exists(folder):
            return 0
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        return max((int(n[:_DIGITS]) for n in names if n.endswith(".json") and not n.startswith(".")), default=0)

    def _content(self, version: int) -> dict:
        p, fs = self._at(self._file(version))
        stream = fs.open(p)
        try:
            return json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _folders(self, version: int) -> list[str]:
        out = []
        while version:
            content = self._content(version)
            out.append(f"{self.path}/{content['folder']}")
            if content["whole"]:
                break
            version -= 1
        return out

    # -------------------------------------------------------------- the table
    def read(self, version: int | None = None) -> DataFrame:
        """``(run_id, config)`` as of a version, the newest by default."""
        found = self._folders(self.version() if version is None else version)
        schema = "run_id bigint, config string"
        return self.spark.read.schema(schema).parquet(*found) if found else self.spark.createDataFrame([], schema)

    def register(self, requests: DataFrame, except_keys: Sequence[str] = (), key: str = "config_id") -> DataFrame:
        """``(key, status, run_id, reused)``, one row per request, after every slot is stored.

        A request reuses the lowest stored run whose configuration holds all of its entries, where keys under
        ``except_keys`` do not count. Requests without one are taken in the order of ``key``: the first
        of those that hold all its entries gives it a slot, its own if that is itself. New slots count on
        from the highest. So a second call with the same requests finds every slot again and stores nothing. Requests that are
        no objects get no slot.
        """
        requests = materialize(requests.select(key, F.col("config").cast("string").alias("config")))
        for _ in range(ATTEMPTS):
            version = self.version()
            stored = self.read(version)
            matched = materialize(match_registry(requests, stored, except_keys, key))
            fresh = materialize(_first_of_each_tree(requests, matched, key))
            if fresh.isEmpty():
                return _slots(matched, None, key)
            owners = materialize(_owners(fresh, except_keys, stored))
            if self._store(owners, fresh, version):
                return _slots(matched, owners, key)
        raise RuntimeError(f"{ATTEMPTS} other writers were faster at {self.path}")

    def _store(self, owners: DataFrame, fresh: DataFrame, version: int) -> bool:
        name = f"data/{uuid.uuid4().hex}"
        new = owners.where("own").join(fresh, "fp").select("run_id", "config")
        whole = (version + 1) % WHOLE_EVERY == 0
        if whole:
            new = self.read(version).unionByName(new)
        new.write.mode("errorifexists").parquet(f"{self.path}/{name}")
        done = self._publish(version + 1, {"folder": name, "whole": whole})
        if not done:
            p, fs = self._at(name)
            fs.delete(p, True)
        return done


def _first_of_each_tree(requests: DataFrame, matched: DataFrame, key: str) -> DataFrame:
    """``(fp, first, config)``: the first request of each tree that no stored run matches."""
    left = matched.where("status = 'ok' AND matched_run IS NULL").select(key, "fp")
    first = left.groupBy("fp").agg(F.min(key).alias("first"))
    return first.join(requests.withColumnRenamed(key, "first").groupBy("first").agg(F.min("config").alias("config")), "first")


def _owners(fresh: DataFrame, except_keys: Sequence[str], stored: DataFrame) -> DataFrame:
    """``(fp, run_id, own)``: the new slot of each new tree, and whether the tree is the one to be stored for it.

    A tree's slot is that of the first new tree that holds all of its entries. That one has a slot of its own: were it
    held by an earlier one, so would be the tree.
    """
    as_stored = fresh.select(F.col("first").alias("run_id"), "config")
    m = materialize(match_registry(fresh.select("first", "config"), as_stored, except_keys, "first").select("first", "matched_run"))
    top = stored.select(F.coalesce(F.max("run_id"), F.lit(0))).scalar()
    slots = consecutive_index(m.where("matched_run = first").select("first"), "first").select(
        F.col("first").alias("matched_run"), (top + F.col("idx") + 1).alias("run_id"))
    return m.join(slots, "matched_run").join(fresh.select("first", "fp"), "first").select(
        "fp", "run_id", (F.col("matched_run") == F.col("first")).alias("own"))


def _slots(matched: DataFrame, owners: DataFrame | None, key: str) -> DataFrame:
    if owners is None:
        return matched.select(key, "status", F.col("matched_run").alias("run_id"), F.col("matched_run").isNotNull().alias("reused"))
    return matched.join(owners.select("fp", F.col("run_id").alias("new_run")), "fp", "left").select(
        key, "status", F.coalesce("matched_run", "new_run").alias("run_id"), F.col("matched_run").isNotNull().alias("reused"))
