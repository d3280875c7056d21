"""Tables whose state changes in one step.

Under a table's folder, data lies in folders that are never written twice, and
``_commits`` holds one small numbered file per state, which names the data folders of that
state. A write first completes its data folder, then writes the commit beside, and puts it in
place by a rename to the next number as its last step: a reader, who resolves the largest
number, sees the old or the new state whole, whenever a writer dies. A second writer of the
same number is refused where the file system refuses a rename onto a file. ``vacuum`` deletes
what no kept state names, leftovers of dead writers included.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


class Conflict(RuntimeError):
    """Another writer has put a state in place meanwhile."""


@dataclass
class State:
    number: int = 0
    folders: dict[str, str] = field(default_factory=dict)  # part -> folder under the table
    schema: str | None = None
    info: dict = field(default_factory=dict)


class Versions:
    """The states of the table under ``path`` (a folder that driver and executors share)."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._new = spark._jvm.org.apache.hadoop.fs.Path
        self.fs = self._new(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _commits(self) -> list:
        """(number, path) in ascending order."""
        folder = self._new(f"{self.path}/_commits")
        found = self.fs.listStatus(folder) if self.fs.exists(folder) else []
        named = [(s.getPath().getName(), s.getPath()) for s in found]
        return sorted((int(n.removesuffix(".json")), p) for n, p in named if n.endswith(".json") and not n.startswith("."))

    def _state(self, number: int, path) -> State:
        stream = self.fs.open(path)
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return State(number=number, **json.loads(text))

    def current(self) -> State:
        """The latest state; number 0 and no folders before the first."""
        commits = self._commits()
        return self._state(*commits[-1]) if commits else State()

    def new_folder(self) -> str:
        """Name of a data folder that nobody has written."""
        return f"data-{uuid.uuid4().hex}"

    def commit(self, after: State, folders: dict[str, str], schema: str | None = None, **info) -> State:
        """Put the state that follows ``after`` in place."""
        new = State(after.number + 1, folders, schema, info)
        beside = self._new(f"{self.path}/_commits/.{uuid.uuid4().hex}")
        out = self.fs.create(beside, False)
        out.write(bytearray(json.dumps({"folders": folders, "schema": schema, "info": info}).encode()))
        out.close()
        self._place(beside, self._new(f"{self.path}/_commits/{new.number:012d}.json"))
        return new

    def _place(self, beside, target) -> None:
        if self.fs.exists(target) or not self.fs.rename(beside, target):
            self.fs.delete(beside, False)
            raise Conflict(f"{target.getName()} of {self.path} was put in place by another writer")

    def paths(self, state: State, parts=None) -> list[str]:
        """Absolute data folders of a state, those of ``parts`` only if given."""
        return [f"{self.path}/{f}" for p, f in sorted(state.folders.items()) if parts is None or p in parts]

    def vacuum(self, keep: int = 1) -> int:
        """Delete folders and commits that the last ``keep`` states don't need; the number of folders deleted."""
        commits = self._commits()
        held = {f.split("/")[0] for n, p in commits[-keep:] for f in self._state(n, p).folders.values()}
        for _, p in commits[:-keep]:
            self.fs.delete(p, False)
        gone = 0
        root = self._new(self.path)
        for status in self.fs.listStatus(root) if self.fs.exists(root) else []:
            name = status.getPath().getName()
            if name.startswith("data-") and name not in held:
                self.fs.delete(status.getPath(), True)
                gone += 1
        return gone


class VersionedTable(Versions):
    """A Parquet table that is replaced as a whole."""

    def replace(self, df: DataFrame, after: State | None = None, **info) -> State:
        """Write ``df`` (which may read the table itself) as the state after ``after`` (the latest one)."""
        after = after or self.current()
        folder = self.new_folder()
        df.write.parquet(f"{self.path}/{folder}")
        return self.commit(after, {"all": folder}, df.schema.json(), **info)

    def read(self, state: State | None = None, parts=None) -> DataFrame | None:
        """The table in its latest (or given) state; None before the first."""
        state = state or self.current()
        if state.schema is None:
            return None
        schema = T.StructType.fromJson(json.loads(state.schema))
        paths = self.paths(state, parts)
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)
