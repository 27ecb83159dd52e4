"""Written intermediate tables: lineage is cut in a folder that all executors share."""

from __future__ import annotations

import hashlib
import json
import os
import uuid
from collections.abc import Callable
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


#: Lists of scratch paths to be deleted, the innermost ``scratch_cleared`` last.
_HELD: list[list[str]] = []


def shared_root(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir. In local mode one below the warehouse serves where none is named."""
    if named := spark.conf.get("spark.checkpoint.dir", None):
        return named
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{spark.conf.get('spark.sql.warehouse.dir')}/checkpoints"


def scratch_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"
    if _HELD:
        _HELD[-1].append(path)
    return path


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: what follows doesn't recompute it."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def once(spark: SparkSession, path: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A stage that a restarted job doesn't do again: the table at ``path`` if it was written to its end, else it is built and written there.

    What a stopped job left there is replaced. ``Stages`` asks what it was built from too.
    """
    fs, done = _file_system(spark, f"{path}/_SUCCESS")
    if not fs.exists(done):
        build().write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)


def _file_system(spark: SparkSession, path: str):
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(conf), where


def fingerprint(spark: SparkSession, path: str) -> str:
    """A digest of the names, lengths and times of the files below a path (or of those a pattern names); no data is read."""
    fs, where = _file_system(spark, path)
    told = []
    for found in fs.globStatus(where) or []:
        files = fs.listFiles(found.getPath(), True)
        while files.hasNext():
            f = files.next()
            if not f.getPath().getName().startswith(("_", ".")):
                told.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return hashlib.sha256(json.dumps(sorted(told)).encode()).hexdigest()


class Stages:
    """Written stages of a run, which a restarted run takes up where the last one stopped.

    A stage's key is a digest of its name, its settings, the fingerprints of its inputs and the keys
    of the stages that it names as inputs. Its table lies in a folder named by the key. It is
    committed by a file that is written beside and renamed into the folder when the table is whole:
    what a killed run left without it is written again. A changed input or setting gives other
    keys, so that stage and those after it run again; ``clean`` deletes tables of other keys.
    """

    MARK = "_stage.json"

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.keys: dict[str, str] = {}
        self.built: list[str] = []

    def key_of(self, name: str, inputs: list[str], settings: dict | None) -> str:
        told = [self.keys.get(i) or fingerprint(self.spark, i) for i in inputs]
        return hashlib.sha256(json.dumps([name, told, settings or {}], sort_keys=True, default=str).encode()).hexdigest()[:32]

    def table(self, name: str, build: Callable[[], DataFrame], *, inputs: list[str] | tuple[str, ...] = (), settings: dict | None = None) -> DataFrame:
        """The stage's table: read if it is committed, else built and committed. ``inputs`` are paths and names of earlier stages."""
        key = self.key_of(name, list(inputs), settings)
        at = f"{self.folder}/{name}/{key}"
        fs, mark = _file_system(self.spark, f"{at}/{self.MARK}")
        if fs.exists(mark):
            out = self.spark.read.schema(_schema(json.loads(self._read(fs, mark))["schema"])).parquet(at)
        else:
            made = build()
            made.write.mode("overwrite").option("compression", "zstd").parquet(at)
            told = {"name": name, "inputs": list(inputs), "settings": settings or {}, "schema": made.schema.json()}
            _, beside = _file_system(self.spark, f"{at}/_{uuid.uuid4().hex}")
            stream = fs.create(beside, True)
            stream.write(bytearray(json.dumps(told, default=str).encode()))
            stream.close()
            if not fs.rename(beside, mark):
                raise OSError(f"stage {name} couldn't be committed at {at}")
            out = self.spark.read.schema(made.schema).parquet(at)
            self.built.append(name)
        self.keys[name] = key
        return out

    @staticmethod
    def _read(fs, path) -> str:
        stream = fs.open(path)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def clean(self) -> None:
        """Delete the tables of this run's stages that have other keys than this run's."""
        for name, key in self.keys.items():
            fs, where = _file_system(self.spark, f"{self.folder}/{name}")
            for found in fs.listStatus(where):
                if found.getPath().getName() != key:
                    fs.delete(found.getPath(), True)


def _schema(text: str) -> T.StructType:
    return T.StructType.fromJson(json.loads(text))


def delete_path(spark: SparkSession, path: str) -> None:
    fs, where = _file_system(spark, path)
    fs.delete(where, True)


def discard(df: DataFrame) -> None:
    """Delete the files below a table that ``materialise`` gave and nothing reads any more."""
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        delete_path(df.sparkSession, folder)


@contextmanager
def scratch_cleared(spark: SparkSession):
    """Delete at the end what is written to scratch paths meanwhile. What is to stay is written to a path taken before."""
    _HELD.append([])
    try:
        yield
    finally:
        for path in _HELD.pop():
            delete_path(spark, path)


#: Rows of an Arrow batch where the session doesn't say: rows may hold long texts.
BATCH_ROWS = 512
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def find_package(spark: SparkSession) -> None:
    """Ready the session for Python workers.

    Those on this machine import the package from where the driver did; on a cluster it is
    installed or sent with --py-files, and the path then names nothing. Arrow batches hold
    BATCH_ROWS rows unless the session sets another number than Spark's default of 10000.
    """
    env, root = spark.sparkContext.environment, str(Path(__file__).resolve().parents[2])
    parts = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in parts:
        env["PYTHONPATH"] = os.pathsep.join([*parts, root])
    if spark.conf.get(_BATCH) == "10000":
        spark.conf.set(_BATCH, BATCH_ROWS)
