"""What a batch has finished, so that its next run goes on behind it instead of doing it all again.

``root/b=<batch>/<table>`` is a small file, written when the table is. Spark gives a batch that runs again the same rows, so a
finished write needs no repeating, as long as its table is there and it was made under the same settings; else it is made
anew, and so is all that comes after it.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import SparkSession

from tallywatch.sources import storage


class Progress:
    def __init__(self, spark: SparkSession, root: str, batch_id: int, settings: dict, after_write: Callable[[str], None] | None):
        self.spark, self.root, self.batch_id, self.settings, self.after_write = spark, root, batch_id, settings, after_write
        self.resuming = True  # until a write is not found finished
        self.resumed = False  # some were

    def _mark(self, table: str) -> str:
        return f"{self.root}/b={self.batch_id}/{table}"

    def _finished(self, table: str, target: str, settings: dict) -> dict | None:
        said = storage.read_text(self.spark, self._mark(table))
        if said is None or not storage.exists(self.spark, f"{target}/_SUCCESS"):
            return None
        said = json.loads(said)
        return said["counts"] if said["settings"] == settings else None

    def once(self, table: str, target: str, write: Callable[[], dict | None], **more) -> dict:
        """The counts that ``write`` returns, of this run or of the one that finished it. ``target`` is the folder it ends with;
        ``more`` are settings of this table alone."""
        settings = {**self.settings, **more}
        counts = self._finished(table, target, settings) if self.resuming else None
        if counts is None:
            self.resuming = False
            storage.delete_tree(self.spark, self._mark(table))
            counts = write() or {}
            storage.write_text(self.spark, self._mark(table), json.dumps({"settings": settings, "counts": counts}))
            if self.after_write:
                self.after_write(table)
        else:
            self.resumed = True
        return counts

    def forget_older(self) -> None:
        """Drop what earlier batches left; they can't run again."""
        for name in storage.child_names(self.spark, self.root):
            if name.startswith("b=") and int(name[2:]) < self.batch_id:
                storage.delete_tree(self.spark, f"{self.root}/{name}")
