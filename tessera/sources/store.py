"""Finished results that later runs read back.

A result is addressed by the name of its operator, all of the operator's
parameters and the fingerprint of its input files (path, length and
modification time). It counts as finished when its marker exists, which is
created after the data, in one step, and never replaced; so

* a restarted driver reads back what was finished and computes the rest;
* a half-written folder has no marker and is never read;
* changed parameters or changed input files make another address, and an old
  result is never met;
* of two drivers that compute the same result, the first marker wins and both
  read its data.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.sources.storage import checkpoint_root

MARKER = "finished.json"


def _path(spark: SparkSession, path: str):
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_fingerprint(spark: SparkSession, *paths: str) -> str:
    """Digest of the files at or below the paths, by path, length and modification time.

    A folder is listed in one go, so the calls to the file system grow with
    the folders, not with the files. Hidden files (``_``, ``.``) don't count;
    a path that isn't there is a state of its own.
    """
    digest = hashlib.sha256()
    for path in paths:
        at, fs = _path(spark, path)
        found = []
        if fs.exists(at):
            files = fs.listFiles(at, True)
            while files.hasNext():
                f = files.next()
                if f.getPath().getName()[:1] not in "_.":
                    found.append([f.getPath().toString(), f.getLen(), f.getModificationTime()])
        digest.update(json.dumps([path, sorted(found)]).encode())
    return digest.hexdigest()


def input_fingerprint(*inputs: DataFrame) -> str:
    """Digest of the files behind the inputs.

    Inputs without files (made in memory) are refused: a result of them
    couldn't be told from another's.
    """
    folders: dict[str, None] = {}
    for df in inputs:
        files = df.inputFiles()
        if not files:
            raise ValueError("the input has no files to go by")
        jvm = df.sparkSession.sparkContext._jvm
        folders |= dict.fromkeys(sorted({str(jvm.java.net.URI(f.rsplit("/", 1)[0])) for f in files}))
    digest = hashlib.sha256()
    for df in inputs:
        digest.update(json.dumps(sorted(df.inputFiles())).encode() + b"|")
    return digest.hexdigest() + path_fingerprint(inputs[0].sparkSession, *folders)


class ResultStore:
    """Results below one folder; without a path, in the session's shared checkpoint folder."""

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = (root or f"{checkpoint_root(spark)}/tessera-results").rstrip("/")

    def address(self, operator: str, params: dict, inputs: list[DataFrame]) -> str:
        key = json.dumps([operator, params, input_fingerprint(*inputs)], sort_keys=True, default=str)
        return f"{self.root}/{operator}-{hashlib.sha256(key.encode()).hexdigest()[:32]}"

    def find(self, operator: str, params: dict, inputs: list[DataFrame]) -> DataFrame | None:
        """The finished result, if there is one."""
        folder = self.address(operator, params, inputs)
        marker = self._marker(folder)
        return None if marker is None else self._read(folder, marker)

    def get(self, operator: str, params: dict, inputs: list[DataFrame], build: Callable[[], DataFrame],
            compression: str = "gzip") -> DataFrame:
        """The finished result, or the result of ``build``, written, marked and read back.

        ``params`` has everything besides the inputs that the result depends
        on, as JSON values. What a broken run left beside the marker is
        removed when the address is built again.
        """
        folder = self.address(operator, params, inputs)
        marker = self._marker(folder)
        if marker is None:
            attempt = f"data-{uuid.uuid4().hex}"
            df = build()
            rows = Observation(f"rows_{attempt}")
            df.observe(rows, F.count(F.lit(1)).alias("rows")).write.parquet(f"{folder}/{attempt}", compression=compression)
            self._mark(folder, {"data": attempt, "rows": int(rows.get["rows"]), "schema": df.schema.json(), "params": params})
            marker = self._marker(folder)
            self._sweep(folder, marker["data"])
        return self._read(folder, marker)

    def forget(self, operator: str, params: dict, inputs: list[DataFrame]) -> None:
        path, fs = _path(self.spark, self.address(operator, params, inputs))
        fs.delete(path, True)

    def _marker(self, folder: str) -> dict | None:
        path, fs = _path(self.spark, f"{folder}/{MARKER}")
        if not fs.exists(path):
            return None
        return json.loads(self.spark.read.text(f"{folder}/{MARKER}", wholetext=True).first()[0])

    def _mark(self, folder: str, content: dict) -> None:
        # written aside, then renamed: the marker is there in full or not at all, and an older one stays
        aside, fs = _path(self.spark, f"{folder}/.{uuid.uuid4().hex}")
        out = fs.create(aside, False)
        out.write(bytearray(json.dumps(content, default=str).encode()))
        out.close()
        marker, _ = _path(self.spark, f"{folder}/{MARKER}")
        try:
            renamed = not fs.exists(marker) and fs.rename(aside, marker)
        except Py4JJavaError:
            renamed = False
        if not renamed:
            fs.delete(aside, False)
            if not fs.exists(marker):
                raise OSError(f"can't finish {folder}")

    def _sweep(self, folder: str, keep: str) -> None:
        path, fs = _path(self.spark, folder)
        for status in fs.listStatus(path):
            name = status.getPath().getName()
            if name.startswith("data-") and name != keep and fs.exists(_path(self.spark, f"{folder}/{name}/_SUCCESS")[0]):
                fs.delete(status.getPath(), True)

    def _read(self, folder: str, marker: dict) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(marker["schema"]))
        out = self.spark.read.schema(schema).parquet(f"{folder}/{marker['data']}")
        out._tessera_rows = marker["rows"]
        return out
