"""A keyed table that grows by micro-batches: rows in hash buckets, folded in levels.

Every batch writes one run of its own rows; after ``fan`` runs of a level their newest rows become one run of the next level, so a key is read
from a logarithmic number of runs. A reader that knows its keys opens their buckets only. Runs of batch n and later are invisible to a
replay of batch n, and the sources of a folded run stay until the following batch, so a replay finds what the first attempt found.
Where the table format supports MERGE, use ``DataFrame.mergeInto`` instead.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweave.streaming.store import table_exists

RUN = re.compile(r"run=(\d+)-(\d+)-(\d+)")


class Run(NamedTuple):
    first: int
    last: int
    level: int


@dataclass
class BucketTable:
    """``keys`` name a row, the newest batch wins; ``by`` (some of the keys) choose its bucket."""

    spark: SparkSession
    path: str
    keys: list[str]
    by: list[str]
    buckets: int = 64
    fan: int = 8

    def _bucket(self):
        return F.pmod(F.xxhash64(*self.by), F.lit(self.buckets)).cast("int")

    def _runs(self, before: int | None) -> list[Run]:
        """All complete runs that end before the bound."""
        if not table_exists(self.spark, self.path):
            return []
        at = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        found = at.getFileSystem(self.spark._jsc.hadoopConfiguration()).listStatus(at)
        runs = [Run(*map(int, m.groups())) for m in (RUN.fullmatch(s.getPath().getName()) for s in found) if m]
        return [r for r in runs if (before is None or r.last < before) and table_exists(self.spark, f"{self._folder(r)}/_SUCCESS")]

    def _folder(self, run: Run) -> str:
        return f"{self.path}/run={run.first}-{run.last}-{run.level}"

    def live(self, before: int | None = None) -> list[Run]:
        """Runs that together hold everything: a folded run stands for its sources."""
        runs = self._runs(before)
        return sorted(r for r in runs if not any(o.level > r.level and o.first <= r.first and r.last <= o.last for o in runs))

    def write(self, rows: DataFrame, batch_id: int) -> None:
        """The rows of a batch; a replay writes the same run again. Folds full levels and removes runs that were folded before this batch."""
        runs = self.live(batch_id)
        for old in self._runs(batch_id):
            if old not in runs:
                self._remove(old)
        runs.append(Run(batch_id, batch_id, 0))
        self._store(rows.withColumn("batch", F.lit(batch_id).cast("long")), runs[-1])
        while len(runs) >= self.fan and len({r.level for r in runs[-self.fan:]}) == 1:
            last = runs[-self.fan:]
            log = self._open(last)
            if log is None:
                break
            runs = [*runs[:-self.fan], Run(last[0].first, last[-1].last, last[0].level + 1)]
            self._store(self._newest(log), runs[-1])

    def _store(self, rows: DataFrame, run: Run) -> None:
        rows.withColumn("bucket", self._bucket()).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(self._folder(run))

    def _remove(self, run: Run) -> None:
        at = self.spark._jvm.org.apache.hadoop.fs.Path(self._folder(run))
        at.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(at, True)

    def _open(self, runs: list[Run]) -> DataFrame | None:
        paths = [self._folder(r) for r in runs if self._filled(r)]
        return self.spark.read.option("basePath", self.path).parquet(*paths).drop("run") if paths else None

    def _newest(self, log: DataFrame) -> DataFrame:
        columns = [c for c in log.columns if c != "bucket"]
        key = [F.col(k).alias(f"_k_{k}") for k in self.keys]
        return log.groupBy(*key).agg(F.max_by(F.struct(*columns), F.col("batch")).alias("_row")).select("_row.*")

    def read(self, before: int | None = None, wanted: DataFrame | None = None) -> DataFrame | None:
        """Newest row per key; with ``wanted`` (the columns ``by``) only of those keys and from their buckets. None before the first run."""
        log = self._open(self.live(before))
        if log is None:
            return None
        if wanted is not None:
            wanted = wanted.select(*self.by).distinct()
            touched = [r.b for r in wanted.select(self._bucket().alias("b")).distinct().collect()]  # at most as many as buckets
            log = log.where(F.col("bucket").isin(touched)).join(wanted, self.by, "left_semi")
        return self._newest(log).drop("batch")

    def _filled(self, run: Run) -> bool:
        at = self.spark._jvm.org.apache.hadoop.fs.Path(self._folder(run))
        return any(s.isDirectory() for s in at.getFileSystem(self.spark._jsc.hadoopConfiguration()).listStatus(at))
