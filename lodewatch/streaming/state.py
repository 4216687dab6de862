"""Upserted results of a stream as a log of parts that are merged as the log grows.

Every micro-batch writes its changed rows to a part of its own. `fanout` parts of one level are merged by key to one part
of the next level, so that a log of n batches has at most `fanout` parts on each of log(n) levels to read, however long
the stream runs, and every row is rewritten once a level.

Nothing depends on a swap: each row carries the batch that it comes from, and a key's latest row wins whether it is read from
a batch's part, from a merged one, or from both. A part counts once its marker file stands, which is written last; parts
inside the range of a finished higher part are not read, and deleted when the next merge begins, so that readers that listed
them have time. Only batches before the running one are merged: they are committed and never come again, while
the running one may, and then replaces its part. A merge that was cut off is simply done again.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH = "_batch_id"
FANOUT = 8
MARKER = "_FINISHED"


@dataclass(frozen=True, order=True)
class Part:
    level: int
    first: int
    last: int

    @property
    def folder(self) -> str:
        return f"part-{self.level}-{self.first}-{self.last}"

    @staticmethod
    def named(folder: str) -> Part | None:
        pieces = folder.split("-")
        return Part(*map(int, pieces[1:])) if pieces[0] == "part" and len(pieces) == 4 else None

    def within(self, other: Part) -> bool:
        return other.level > self.level and other.first <= self.first and self.last <= other.last


class PartLog:
    """The parts below one folder of a file system that driver and executors share."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        root = self._jvm.org.apache.hadoop.fs.Path(self.path)
        self._fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _at(self, part: Part, *below: str):
        return self._jvm.org.apache.hadoop.fs.Path("/".join([self.path, part.folder, *below]))

    def finished(self) -> list[Part]:
        """All parts whose marker stands, in the order of level and batches."""
        markers = self._fs.globStatus(self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/part-*/{MARKER}"))
        return sorted(p for m in markers or () if (p := Part.named(m.getPath().getParent().getName())))

    def live(self) -> list[Part]:
        """The parts that together hold every key's latest row."""
        parts = self.finished()
        return [p for p in parts if not any(p.within(q) for q in parts)]

    def write(self, rows: DataFrame, part: Part) -> None:
        """Writes a part, or replaces it; it counts from the moment its marker stands."""
        rows.write.mode("overwrite").parquet(f"{self.path}/{part.folder}")
        self._fs.create(self._at(part, MARKER), True).close()

    def read(self, parts: Sequence[Part], schema: str) -> DataFrame:
        folders = [f"{self.path}/{p.folder}" for p in parts]
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def merge(self, keys: Sequence[str], before: int, fanout: int = FANOUT) -> int:
        """Merges wherever `fanout` parts of a level lie before batch `before`; returns the number of merges."""
        parts = self.finished()
        for old in [p for p in parts if any(p.within(q) for q in parts)]:
            self._fs.delete(self._at(old), True)
        done, level = 0, 0
        live = self.live()
        while level <= max((p.level for p in live), default=-1):
            ready = [p for p in live if p.level == level and p.last < before]
            if len(ready) < fanout:
                level += 1
                continue
            chosen = ready[:fanout]
            rows = self.spark.read.parquet(*[f"{self.path}/{p.folder}" for p in chosen])
            self.write(latest(rows, keys), Part(level + 1, chosen[0].first, chosen[-1].last))
            live = self.live()
            done += 1
        return done


def latest(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The row of each key from its last batch, with that batch."""
    values = [c for c in rows.columns if c not in keys and c != BATCH]
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), BATCH).alias("_v"), F.max(BATCH).alias(BATCH))
    return newest.select(*keys, *[F.col("_v")[v].alias(v) for v in values], BATCH)
