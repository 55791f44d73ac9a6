"""What a run has finished: stored stages and written outputs, each under a key of its inputs and parameters.

A stage counts once its entry is written, which is done after its data. A rerun over the same files and
parameters reads finished stages and goes on with the first that is missing; a changed parameter gives new keys
from its stage on. Data of a stage without an entry are leftovers of a lost run and are replaced.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cytospark.session import discard


def files_key(spark: SparkSession, folders: Sequence[str], extension: str) -> str:
    """Changes when a file is added, removed or rewritten; reads the listing only."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", f"*{extension}").load(list(folders))
    row = files.agg(F.count(F.lit(1)), F.sum(F.xxhash64("path", "modificationTime", "length").cast("decimal(38,0)"))).first()
    return f"{row[0]}-{row[1]}"


class Ledger:
    """Entries of one output folder. Stages build on each other in the order in which they are asked for."""

    def __init__(self, spark: SparkSession, folder: str, inputs: str):
        self.spark, self.folder, self.key = spark, folder.rstrip("/"), inputs
        self.made: list[str] = []  # stages and outputs that this run had to make

    def _next(self, name: str, settings: dict) -> str:
        text = json.dumps([self.key, name, settings], sort_keys=True, default=list)
        self.key = hashlib.sha256(text.encode()).hexdigest()[:20]
        return f"{self.folder}/ledger/{name}-{self.key}"

    def _note(self, entry: str) -> str | None:
        place = self.spark._jvm.org.apache.hadoop.fs.Path(f"{entry}/_SUCCESS")
        if not place.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(place):
            return None
        return self.spark.read.text(entry).first()[0]

    def _enter(self, entry: str, name: str, note: str) -> None:
        self.spark.createDataFrame([(note,)], "note string").coalesce(1).write.mode("overwrite").text(entry)
        self.made.append(name)

    def table(self, name: str, settings: dict, build: Callable[[], DataFrame], partition_by: Sequence[str] = ()) -> DataFrame:
        """The stored table of a stage; built only if it has no entry."""
        entry = self._next(name, settings)
        path = f"{self.folder}/stages/{name}-{self.key}"
        note = self._note(entry)
        if note is None:
            df = build()
            df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
            note = df.schema.json()
            self._enter(entry, name, note)
        return self.spark.read.schema(T.StructType.fromJson(json.loads(note))).parquet(path)

    def output(self, name: str, write: Callable[[str], None]) -> str:
        """Files made from the stages so far, written once; returns their folder."""
        before = self.key
        entry = self._next(f"output-{name}", {})
        self.key = before  # outputs are ends: no stage depends on them
        path = f"{self.folder}/{name}"
        if self._note(entry) is None:
            discard(self.spark, path)
            write(path)
            self._enter(entry, f"output {name}", path)
        return path
