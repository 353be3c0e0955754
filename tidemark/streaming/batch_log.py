"""Rows of a stream's batches, stored once and kept in few folders.

Every batch writes a folder of its own and then a version: a small list of the
folders that hold all rows so far.  Readers take the latest version, so a batch
counts from the moment its version is there, and one that is replayed writes
the same folders and the same version again.

Folders fold: as soon as ``FOLD`` of a level lie side by side they are written
together as one of the next level.  After n batches there are at most
``(FOLD - 1) * log(n)`` folders, each row is rewritten once for each level, and
what is folded is at most ``LARGEST`` bytes, so that no batch waits for a fold
of the whole history; folders of that size stay as they are.  Versions are kept
for ``RETAINED`` batches; then the folders that they alone named are removed.

A version remembers the stream (the id in its checkpoint) and the batch that
wrote it.  A stream begun anew over the same folder numbers its batches from 0
again; its rows come after those stored before.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.sources.shared_files import bytes_in, names_in, read_text, remove, write_text

FOLD = 8
LARGEST = 8 << 30
RETAINED = 20
#: Bytes of a file that a fold writes.
FILE_BYTES = 128 << 20


class BatchLog:
    """The rows that batches stored below ``path``."""

    def __init__(self, spark: SparkSession, path: str, schema: str, fold: int = FOLD, retained: int = RETAINED):
        self.spark, self.path, self.schema = spark, path, schema
        self.fold, self.retained = fold, retained

    def _versions(self) -> list[int]:
        return [int(name.split(".")[0]) for name in names_in(self.spark, f"{self.path}/_versions") if name.endswith(".json")]

    def _version(self, number: int) -> dict:
        text = read_text(self.spark, f"{self.path}/_versions/{number:012d}.json")
        return json.loads(text) if text else {"number": -1, "by": None, "folders": [], "replaced": []}

    def _latest(self) -> dict:
        return self._version(max(self._versions(), default=-1))

    def _base(self, by: list) -> dict:
        """What a batch builds on: the latest version, or if the batch wrote that
        one itself before a replay, the one before it."""
        latest = self._latest()
        return self._version(latest["number"] - 1) if latest["by"] == by else latest

    def _rows(self, folders: list[dict]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/{each['name']}" for each in folders])

    def folders(self) -> list[str]:
        """The folders of the latest version."""
        return [f"{self.path}/{each['name']}" for each in self._latest()["folders"]]

    def rows(self) -> DataFrame:
        """All stored rows."""
        return self._rows(self._latest()["folders"])

    def before(self, stream: str, batch_id: int) -> DataFrame:
        """The rows stored before a batch, also when the batch is replayed."""
        return self._rows(self._base([stream, batch_id])["folders"])

    def store(
        self, batch: DataFrame, stream: str, batch_id: int, on_fold: Callable[[DataFrame], DataFrame] | None = None
    ) -> DataFrame:
        """Store a batch's rows and return them as stored.  ``on_fold`` is applied
        to rows that are folded; it may leave out what is no longer needed."""
        by = [stream, batch_id]
        base = self._base(by)
        number = base["number"] + 1
        own = {"name": f"rows-{number}-{number}", "first": number, "level": 0}
        batch.write.mode("overwrite").parquet(f"{self.path}/{own['name']}")
        folders, replaced = [*base["folders"], own], []
        while self._foldable(folders):
            last = folders[-self.fold :]
            folders = [*folders[: -self.fold], self._folded(last, number, on_fold)]
            # What was folded within this version is named by no version at all.
            replaced += [each["name"] for each in last]
        version = {"number": number, "by": by, "folders": folders, "replaced": replaced}
        write_text(self.spark, f"{self.path}/_versions/{number:012d}.json", json.dumps(version))
        self._tidy(number)
        return self._rows([own])

    def _foldable(self, folders: list[dict]) -> bool:
        last = folders[-self.fold :]
        if len(last) < self.fold or len({each["level"] for each in last}) > 1:
            return False
        return sum(bytes_in(self.spark, f"{self.path}/{each['name']}") for each in last) <= LARGEST

    def _folded(self, folders: list[dict], number: int, on_fold: Callable | None) -> dict:
        size = sum(bytes_in(self.spark, f"{self.path}/{each['name']}") for each in folders)
        first = folders[0]["first"]
        folded = {"name": f"rows-{first}-{number}", "first": first, "level": folders[0]["level"] + 1}
        rows = self._rows(folders)
        rows = on_fold(rows) if on_fold else rows
        rows.coalesce(max(1, -(-size // FILE_BYTES))).write.mode("overwrite").parquet(f"{self.path}/{folded['name']}")
        return folded

    def _tidy(self, number: int) -> None:
        """Drop the versions before the retained ones, and the folders that the
        oldest retained one no longer names."""
        oldest = number - self.retained + 1
        for old in [each for each in self._versions() if each < oldest]:
            for name in self._version(old + 1)["replaced"]:
                remove(self.spark, f"{self.path}/{name}")
            remove(self.spark, f"{self.path}/_versions/{old:012d}.json")
