"""Appends that survive failure: batches of part files, and a list of commits that tells which of them count.

A store is a folder with data/<batch>/ and commits/<number>.json. A batch is written in full first;
its commit, one small file under the next free number, makes it visible. A job that is lost before
its commit leaves files that no reader sees, and its rerun adds the same rows once. A batch that was
committed already is not written again. Two writers that take the same number can't both commit:
the second is told to try again. Commits are made by creating a file that must not exist yet, which
the shared file system has to do atomically.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quizloom.operators.records import new_and_collided


class Conflict(RuntimeError):
    """Another writer committed first; nothing was added, and the append can be tried again."""


class Ledger:
    """A store of records of one schema, each id once; format: json or parquet."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, format: str = "json"):
        self.spark, self.path, self.schema, self.format = spark, path.rstrip("/"), schema, format

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()), p

    def commits(self) -> list[dict]:
        """All commits in order: batch, rows, collided. A file that was cut while it was written is no commit."""
        fs, folder = self._fs(f"{self.path}/commits")
        if not fs.exists(folder):
            return []
        if not any(s.getPath().getName().endswith(".json") for s in fs.listStatus(folder)):
            return []
        found = self.spark.read.schema("batch string, rows long, collided long").json(f"{self.path}/commits").where("batch IS NOT NULL")
        rows = found.select(F.col("_metadata.file_name").alias("file"), "batch", "rows", "collided").orderBy("file").collect()  # one row a batch
        return [{"batch": r.batch, "rows": r.rows, "collided": r.collided} for r in rows]

    def _next(self) -> int:
        fs, folder = self._fs(f"{self.path}/commits")
        names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
        return max((int(n[:12]) for n in names if n[:12].isdigit()), default=0) + 1

    def read(self) -> DataFrame:
        """Rows of committed batches."""
        folders = [f"{self.path}/data/{c['batch']}" for c in self.commits() if c["rows"]]
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).format(self.format).load(folders)

    def append(self, df: DataFrame, ident: str, order: list[str], batch: str | None = None) -> tuple[int, int]:
        """Adds the rows whose id no committed batch has, the first of each in the order given; how many went in, and how many collided.

        A batch of a name that was committed before is left as it was, and told as it was: so a rerun with
        its name is free, and one without a name finds all its ids there. A null id is an id like others.
        Counts come from the writing job itself.
        """
        batch = batch or uuid.uuid4().hex
        for c in self.commits():
            if c["batch"] == batch:
                return c["rows"], c["collided"]
        number = self._next()
        new, collided = new_and_collided(df.select(*self.schema.names), self.read().select(ident), ident, order)
        fresh, seen = Observation(), Observation()
        target = f"{self.path}/data/{batch}"
        rows = new.observe(fresh, F.count("*").alias("n")).write.mode("overwrite")  # what a lost run left under this name goes
        rows.option("ignoreNullFields", "false").format(self.format).save(target)
        collided.observe(seen, F.count("*").alias("n")).write.format("noop").mode("overwrite").save()
        counts = {"batch": batch, "rows": fresh.get["n"], "collided": seen.get["n"]}
        self._commit(number, counts)
        return counts["rows"], counts["collided"]

    def _commit(self, number: int, counts: dict) -> None:
        fs, file = self._fs(f"{self.path}/commits/{number:012d}.json")
        fs.mkdirs(file.getParent())
        try:
            out = fs.create(file, False)
        except Exception as e:
            if "exists" not in str(e).lower():
                raise
            raise Conflict(f"commit {number} is taken") from e
        try:
            out.write(bytearray((json.dumps(counts) + "\n").encode()))
        finally:
            out.close()

    def sweep(self) -> list[str]:
        """Deletes batches that were written and never committed; only while nobody appends. Their names."""
        fs, folder = self._fs(f"{self.path}/data")
        known = {c["batch"] for c in self.commits()}
        lost = [s.getPath() for s in fs.listStatus(folder) if s.getPath().getName() not in known] if fs.exists(folder) else []
        for p in lost:
            fs.delete(p, True)
        return sorted(p.getName() for p in lost)
