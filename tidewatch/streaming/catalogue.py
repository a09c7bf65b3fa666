"""Catalogues (rules, schemas, datasets, output layouts) kept current by their change streams, and the queries that follow.

A change stream is folded into snapshots, one folder per version; an epoch that changes nothing makes none. Queries ask
a :class:`Catalogue` in each micro-batch, which reads and builds only what is new. What a running query can't take over,
such as its list of topics, is settings of a :class:`Supervisor`, which starts the query again from its checkpoint.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Hashable
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.query import StreamingQuery

from tidewatch.streaming.pipeline import epochs_before, start, write_epoch

#: Snapshots that stay for queries which have not yet asked again.
RETAIN = 3
_ANY_EPOCH = 1 << 62


def latest(keys: list[str], order: str, gone: str = "false") -> Callable[[DataFrame], DataFrame]:
    """A fold: the last state of each key by ``order``; a key whose last state is ``gone`` (a condition) has none."""

    def fold(rows: DataFrame) -> DataFrame:
        last = rows.groupBy(*keys).agg(F.max_by(F.struct(*rows.columns), order).alias("_l")).select("_l.*")
        return last.where(~F.coalesce(F.expr(gone), F.lit(False)))

    return fold


def keep(
    changes: DataFrame, fold: Callable[[DataFrame], DataFrame], folder: str,
    prepare: Callable[[DataFrame], DataFrame] = lambda df: df, retain: int = RETAIN, **trigger,
) -> StreamingQuery:
    """Folds a change stream into snapshots: ``fold`` of the last snapshot's rows and the epoch's changes.

    ``fold`` returns the columns it gets, and treats the rows of a snapshot as changes that came before. A snapshot with the rows
    of the last one is dropped. ``folder/log`` says per epoch which version counts, and is written last: an epoch that
    is replayed does its work again if it was not finished, and none if it was. The newest ``retain`` versions stay.
    """

    def work(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        logged = epochs_before(spark, f"{folder}/log", epoch + 1)
        if logged and logged[-1] == f"{folder}/log/epoch={epoch}":
            return
        old = spark.read.parquet(logged[-1]).first() if logged else None
        rows = prepare(batch)
        if old is not None:
            rows = _snapshot(spark, folder, old.version).unionByName(rows)
        write_epoch(fold(rows), f"{folder}/versions", epoch)
        n, mark = _mark(_snapshot(spark, folder, epoch))
        same = old is not None and (old.n, old.mark) == (n, mark)
        version = old.version if same else epoch
        told = [F.lit(version).cast("bigint").alias("version"), F.lit(n).cast("bigint").alias("n"), F.lit(mark).alias("mark")]
        write_epoch(spark.range(1, numPartitions=1).select(*told), f"{folder}/log", epoch)
        stale = epochs_before(spark, f"{folder}/versions", epoch + 1)
        if same:
            _remove(spark, stale.pop())
        for path in stale[: max(0, len(stale) - retain)]:
            _remove(spark, path)

    return start(changes, work, f"{folder}/checkpoint", **trigger)


def _snapshot(spark: SparkSession, folder: str, version: int) -> DataFrame:
    return spark.read.parquet(f"{folder}/versions/epoch={version}")


def _mark(rows: DataFrame) -> tuple[int, str]:
    """Number of rows and a sum of their hashes, as text: equal for equal bags of rows."""
    each = F.xxhash64(F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"})).cast("decimal(20,0)")
    found = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum(each), F.lit(0)).cast("string").alias("mark")).first()
    return found.n, found.mark


def _remove(spark: SparkSession, path: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


class Catalogue:
    """The newest snapshot below ``folder``, and what ``build`` makes of it, such as parsed rules or a schema registry.

    Built once per version. An instance can be given wherever a pipeline asks for its catalogue per
    micro-batch. Before the first snapshot it is ``build`` of ``empty``."""

    def __init__(self, spark: SparkSession, folder: str, empty: DataFrame, build: Callable[[DataFrame], Any] = lambda rows: rows):
        self.spark, self.folder, self.build = spark, folder, build
        self.version, self.built, self._seen = -1, build(empty), None

    def refresh(self) -> int:
        """The version that counts now; -1 before the first."""
        logged = epochs_before(self.spark, f"{self.folder}/log", _ANY_EPOCH)
        if logged and logged[-1] != self._seen:
            version = self.spark.read.parquet(logged[-1]).first().version
            if version != self.version:
                self.built, self.version = self.build(_snapshot(self.spark, self.folder, version)), version
            self._seen = logged[-1]
        return self.version

    def __call__(self, spark: SparkSession | None = None) -> Any:
        self.refresh()
        return self.built


def topic_settings(found: DataFrame) -> dict[str, tuple]:
    """Settings per stream and cluster from :func:`~tidewatch.sources.records.cluster_topics`, for a :class:`Supervisor`: one
    query each, for the clusters of one query are part of its checkpoint. Clusters without topics need no query."""
    rows = found.where(F.size("topics") > 0).select("stream_id", "cluster_name", "bootstrap_servers", "topics", F.map_entries("properties").alias("p")).collect()
    return {
        f"{r.stream_id}-{r.cluster_name}": (r.bootstrap_servers, tuple(r.topics), tuple(sorted((p.key, p.value) for p in r.p or [])))
        for r in rows
    }


class Supervisor:
    """Keeps one query running for each name that ``wanted`` gives settings for.

    ``start(name, settings)`` starts a query from the checkpoint that belongs to the name. In each :meth:`step` a query whose
    settings changed is stopped and started again, one whose name is gone is stopped, and one that ended is started again.
    A query that failed ``attempts`` times in a row, with the same settings, raises its error.
    """

    def __init__(self, wanted: Callable[[], dict[str, Hashable]], start: Callable[[str, Any], StreamingQuery], attempts: int = 3):
        self.wanted, self.start, self.attempts = wanted, start, attempts
        self.running: dict[str, tuple[Hashable, StreamingQuery]] = {}
        self.failures: dict[str, int] = {}

    def step(self) -> dict[str, str]:
        """What was done, by name: ``started``, ``restarted`` (settings), ``resumed`` (ended or failed) or ``stopped``."""
        wanted, done = self.wanted(), {}
        for name in [n for n in self.running if n not in wanted]:
            self.running.pop(name)[1].stop()
            self.failures.pop(name, None)
            done[name] = "stopped"
        for name, settings in wanted.items():
            held = self.running.get(name)
            if held is None:
                done[name] = "started"
            elif held[0] != settings:
                held[1].stop()
                self.failures.pop(name, None)
                done[name] = "restarted"
            elif not held[1].isActive:
                error = held[1].exception()
                self.failures[name] = self.failures.get(name, 0) + 1 if error else 0
                if self.failures[name] >= self.attempts:
                    self.stop()
                    raise error
                done[name] = "resumed"
            else:
                continue
            self.running[name] = (settings, self.start(name, settings))
        return done

    def watch(self, seconds: float, until: Callable[[], bool] = lambda: False) -> None:
        """Steps every ``seconds`` (30 suits topic lists) until told to end; then stops all."""
        try:
            while not until():
                self.step()
                time.sleep(seconds)
        finally:
            self.stop()

    def stop(self) -> None:
        for _, query in self.running.values():
            query.stop()
        self.running = {}
