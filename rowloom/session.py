"""Session set-up, and tables in the shared folder that are released together.

Operators write tables on their way (``stored``), which lie in a *scratch*: a
database of its own below the shared folder, so that dropping it takes all its tables, views
and files along, by public SQL only.  ``with scratch(spark):`` opens one for what
happens inside; scratches nest, and an operator that needs written tables only for its own work
opens one and hands its result over to the one around it.  Without an open
scratch, tables go to the session's own one, which stays until ``release_all``.

    with scratch(spark):
        ranks = windows.ranked(events, ["user"], "ts", "id")   # may write slices
        ranks.write.parquet(target)
    # nothing but the target is left
"""

from __future__ import annotations

import re
import threading
import uuid
import weakref
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "rowloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC time, AQE on and no UI; extra settings override."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The folder all executors share, as named by ``spark.checkpoint.dir``.

    Without it, the warehouse folder, which executors share too.
    """
    return (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
            or spark.conf.get("spark.sql.warehouse.dir"))


#: Whether the shuffle files of a query go when it ends; else they stay until the driver happens to collect garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_cleanups = threading.RLock()
_cleaning: dict[str, tuple[int, str | None]] = {}


@contextmanager
def _shuffles_end_with_the_job(spark: SparkSession) -> Iterator[None]:
    """What a write shuffled is of no use once its table is there, so it doesn't add up over the steps of an operator.

    The setting is put back when the last of several writes at once has ended.
    """
    application = spark.sparkContext.applicationId
    with _cleanups:
        writers, before = _cleaning.get(application, (0, spark.conf.get(SHUFFLE_CLEANUP, None)))
        _cleaning[application] = writers + 1, before
        spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        with _cleanups:
            writers, before = _cleaning.pop(application)
            if writers > 1:
                _cleaning[application] = writers - 1, before
            elif before is None:
                spark.conf.unset(SHUFFLE_CLEANUP)
            else:
                spark.conf.set(SHUFFLE_CLEANUP, before)


class Scratch:
    """A database below the shared folder for what a piece of work writes on its way."""

    def __init__(self, spark: SparkSession):
        own = uuid.uuid4().hex
        self.spark, self.database = spark, f"rowloom_{own}"
        self.folder = f"{scratch_root(spark).rstrip('/')}/rowloom/{own}"
        self._made = False

    def _make(self) -> None:
        if not self._made:
            quoted = self.folder.replace("\\", "\\\\").replace("'", "\\'")
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS spark_catalog.{self.database} LOCATION '{quoted}'")
            self._made = True

    def path(self, name: str) -> str:
        """A fresh path in the scratch; never reused, so never overwritten."""
        self._make()
        return f"{self.folder}/{name}-{uuid.uuid4().hex}"

    def table_name(self, name: str) -> str:
        """A fresh name of a table or view in the scratch."""
        self._make()
        return f"spark_catalog.{self.database}." + re.sub(r"\W", "_", name) + f"_{uuid.uuid4().hex}"

    def stored(self, df: DataFrame, name: str, bucketed: tuple[int, str] | None = None, **options: str) -> DataFrame:
        """``df`` as a table of the scratch: written once, so later uses neither repeat nor differ.

        ``bucketed`` by so many buckets of a column, groups by that column need no shuffle.
        """
        table = self.table_name(name)
        with _shuffles_end_with_the_job(self.spark):
            writer = df.write.format("parquet").options(**options)
            (writer.bucketBy(*bucketed) if bucketed else writer).saveAsTable(table)
        kept = df.sparkSession.table(table)
        _tables[kept] = table
        return kept

    def hand_over(self, df: DataFrame, name: str, **options: str) -> DataFrame:
        """``df`` stored in the scratch around this one: it stays when this one is released."""
        scopes = _open.get()
        around = scopes[:scopes.index(self)] if self in scopes else ()
        return (around[-1] if around else _of_session(self.spark)).stored(df, name, **options)

    def release(self) -> None:
        """Drop everything in it, files included; it can be used again."""
        if self._made:
            self.spark.sql(f"DROP DATABASE IF EXISTS spark_catalog.{self.database} CASCADE")
            self._made = False


_open: ContextVar[tuple[Scratch, ...]] = ContextVar("scratch", default=())
_sessions: dict[str, Scratch] = {}
#: Stored frames and their tables, for an early release.
_tables: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def _of_session(spark: SparkSession) -> Scratch:
    application = spark.sparkContext.applicationId
    if application not in _sessions:
        _sessions[application] = Scratch(spark)
    return _sessions[application]


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Scratch]:
    """What is stored inside the block is dropped at its end, after an error too.

    Frames that read it can't be used any longer: store or collect results inside, or hand them over.
    """
    own = Scratch(spark)
    before = _open.set((*_open.get(), own))
    try:
        yield own
    finally:
        _open.reset(before)
        own.release()


def current_scratch(spark: SparkSession) -> Scratch:
    """The innermost open scratch, or the session's own."""
    scopes = _open.get()
    return scopes[-1] if scopes else _of_session(spark)


def release_all(spark: SparkSession) -> None:
    """Drop what was stored in this session outside any scratch."""
    own = _sessions.pop(spark.sparkContext.applicationId, None)
    if own is not None:
        own.release()


def release(*frames: DataFrame) -> None:
    """Drop the tables of frames that ``stored`` returned, before their scratch ends; other frames are left alone."""
    for frame in frames:
        table = _tables.pop(frame, None)
        if table is not None:
            frame.sparkSession.sql(f"DROP TABLE IF EXISTS {table} PURGE")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, in the current scratch."""
    return current_scratch(spark).path(name)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Give ``DataFrame.checkpoint`` a reliable folder if the session has none."""
    if spark.sparkContext.getCheckpointDir() is None:
        root = scratch_root(spark)
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(root)


def stored(df: DataFrame, name: str, bucketed: tuple[int, str] | None = None, **options: str) -> DataFrame:
    """Written once to the shared folder, in the current scratch, and read again.

    A lost executor costs only what it was doing.
    """
    return current_scratch(df.sparkSession).stored(df, name, bucketed, **options)
