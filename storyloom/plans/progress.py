"""Progress of batch steps and of streams as rows: stage, done, total, message.

A batch stage runs its jobs under a job group of its own; while it runs, a thread reads the tasks that Spark has finished of those it knows. A stream's
stages are its triggers, taken from a query listener. Events are kept on the driver: a few for each stage or trigger, whatever the data.
"""

from __future__ import annotations

import threading
import time
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.listener import StreamingQueryListener

SCHEMA = "n long, stage string, done long, total long, message string"
#: seconds between two looks at the tasks
PAUSE = 0.2


class Progress:
    """Events of stages in the order in which they came. ``tell``: called with each event as it comes."""

    def __init__(self, spark: SparkSession, tell: Callable[[dict[str, Any]], None] | None = None, pause: float = PAUSE) -> None:
        self.spark, self.tell, self.pause = spark, tell, pause
        self.events: list[dict[str, Any]] = []
        self._lock = threading.Lock()

    def event(self, stage: str, done: int, total: int, message: str) -> None:
        with self._lock:
            e = {"stage": stage, "done": done, "total": total, "message": message}
            if self.events and self.events[-1] == e:
                return
            self.events.append(e)
        if self.tell:
            self.tell(e)

    def tasks(self, group: str) -> tuple[int, int]:
        """(finished, all known) tasks of a job group."""
        tracker, done, total = self.spark.sparkContext.statusTracker(), 0, 0
        for job in tracker.getJobIdsForGroup(group):
            info = tracker.getJobInfo(job)
            for stage in info.stageIds if info else ():
                s = tracker.getStageInfo(stage)
                if s:
                    done, total = done + s.numCompletedTasks, total + s.numTasks
        return done, total

    @contextmanager
    def stage(self, name: str) -> Iterator[None]:
        """Events of what runs inside: a first one without tasks, some with what is done so far, and a last one with all of them done, or the error."""
        sc, group, over = self.spark.sparkContext, f"{name}-{uuid.uuid4().hex}", threading.Event()

        def watch() -> None:
            while not over.wait(self.pause):
                done, total = self.tasks(group)
                if total:
                    self.event(name, done, total, "running")

        self.event(name, 0, 0, "started")
        before = sc.getLocalProperty("spark.jobGroup.id")
        sc.setJobGroup(group, name)
        thread = threading.Thread(target=watch, daemon=True)
        thread.start()
        try:
            yield
        except Exception as e:
            over.set()
            thread.join()
            self.event(name, *self.tasks(group), f"failed: {type(e).__name__}")
            raise
        else:
            over.set()
            thread.join()
            total = self.tasks(group)[1]
            self.event(name, total, total, "done")
        finally:
            sc.setLocalProperty("spark.jobGroup.id", before)

    def rows(self) -> DataFrame:
        """(n, stage, done, total, message): all events so far, numbered from 0."""
        with self._lock:
            found = [(i, e["stage"], e["done"], e["total"], e["message"]) for i, e in enumerate(self.events)]
        return self.spark.createDataFrame(found, SCHEMA)

    @contextmanager
    def streams(self) -> Iterator[None]:
        """Events of the streams that run inside: a query's rows so far with each trigger."""
        listener = _Listener(self)
        self.spark.streams.addListener(listener)
        try:
            yield
            # the bus is asynchronous: what has ended inside is told soon after
            until = time.monotonic() + 10
            while listener.open and time.monotonic() < until:
                time.sleep(0.05)
        finally:
            self.spark.streams.removeListener(listener)


class _Listener(StreamingQueryListener):
    def __init__(self, progress: Progress) -> None:
        self.progress = progress
        self.done: dict[str, int] = {}
        self.names: dict[str, str] = {}
        self.open: set[str] = set()

    def onQueryStarted(self, event: Any) -> None:
        run = str(event.runId)
        self.names[run], self.done[run] = event.name or run, 0
        self.open.add(run)
        self.progress.event(self.names[run], 0, 0, "started")

    def onQueryProgress(self, event: Any) -> None:
        run = str(event.progress.runId)
        self.done[run] = self.done.get(run, 0) + event.progress.numInputRows
        self.progress.event(self.names.get(run, run), self.done[run], self.done[run], f"trigger {event.progress.batchId}")

    def onQueryIdle(self, event: Any) -> None:
        pass

    def onQueryTerminated(self, event: Any) -> None:
        run = str(event.runId)
        n = self.done.get(run, 0)
        self.progress.event(self.names.get(run, run), n, n, "failed" if event.exception else "done")
        self.open.discard(run)
