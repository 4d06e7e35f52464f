"""Batches of songs: what is left to do, retries, time limits, and a ledger of attempts."""

from __future__ import annotations

import random
import re
import shlex
import subprocess
import threading
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class RetryError(RuntimeError):
    """All attempts failed; the last fault is the cause."""


def delay(attempt: int, base: float = 1.0, factor: float = 2.0, most: float = 60.0, jitter: float = 0.0) -> float:
    """Seconds to wait after the attempt (from 0): base * factor^attempt, at most ``most``, plus a random share of it."""
    d = min(base * factor**attempt, most)
    return d + random.uniform(0, jitter * d)


def retry(work: Callable, retries: int = 3, base: float = 1.0, factor: float = 2.0, most: float = 60.0, faults: tuple = (Exception,), sleep: Callable = time.sleep):
    """The result of ``work()``, tried ``retries`` + 1 times; a missing file isn't tried again, nor is what took too long."""
    for attempt in range(retries + 1):
        try:
            return work()
        except (FileNotFoundError, TimeoutError):
            raise
        except faults as e:
            if attempt == retries:
                raise RetryError(f"gave up after {retries + 1} attempts") from e
            sleep(delay(attempt, base, factor, most))


@dataclass
class CircuitBreaker:
    """Refuses calls after ``failures`` faults in a row; after ``rest_s`` it lets one through and closes again after ``successes``."""

    failures: int = 3
    rest_s: float = 120.0
    successes: int = 1
    clock: Callable[[], float] = time.monotonic
    state: str = field(default="CLOSED", init=False)
    _count: int = field(default=0, init=False)
    _since: float = field(default=0.0, init=False)

    def call(self, work: Callable):
        if self.state == "OPEN":
            if self.clock() - self._since < self.rest_s:
                raise RuntimeError("the circuit is open")
            self.state, self._count = "HALF_OPEN", 0
        try:
            out = work()
        except Exception:
            self._count = self._count + 1 if self.state == "CLOSED" else self.failures
            if self._count >= self.failures:
                self.state, self._since = "OPEN", self.clock()
            raise
        if self.state == "HALF_OPEN":
            self._count += 1
            if self._count >= self.successes:
                self.state, self._count = "CLOSED", 0
        else:
            self._count = 0
        return out


class Steps:
    """Named steps of a run on the driver: each is tried again after faults, each attempt is ended at a time limit, and the last attempt is timed. What can't
    get better isn't tried again: missing files and paths, and what the caller names in ``final``."""

    def __init__(self, spark: SparkSession, retries: int = 0, timeout_s: float | None = None):
        self.spark, self.retries, self.timeout_s = spark, retries, timeout_s
        self.seconds: dict[str, float] = {}
        self.attempts: dict[str, int] = {}

    def run(self, name: str, work: Callable):
        key, context = re.sub("[^a-z0-9]+", "_", name.lower()).strip("_"), self.spark.sparkContext
        self.attempts[key] = 0

        def attempt():
            self.attempts[key] += 1
            began, late, done, group = time.monotonic(), threading.Event(), threading.Event(), f"tactus-{key}-{uuid.uuid4().hex}"

            def stop():
                late.set()
                while not done.is_set():  # a job that starts only now is ended too
                    context.cancelJobGroup(group)
                    done.wait(0.5)

            timer = threading.Timer(self.timeout_s, stop) if self.timeout_s else None
            context.setJobGroup(group, name, True)
            try:
                if timer:
                    timer.start()
                return work()
            except Exception as e:
                if late.is_set():
                    raise TimeoutError(f"{name} took more than {self.timeout_s} s") from e
                if "PATH_NOT_FOUND" in str(e):
                    raise FileNotFoundError(str(e).splitlines()[0]) from e
                raise
            finally:
                done.set()
                if timer:
                    timer.cancel()
                for p in ("spark.jobGroup.id", "spark.job.description", "spark.job.interruptOnCancel"):
                    context.setLocalProperty(p, None)
                self.seconds[key] = round(time.monotonic() - began, 3)

        return retry(attempt, self.retries, base=0.5)


class Ledger:
    """What has been tried of each song and step, as a table that only grows: song_id, step, state (success, failed), attempt, seconds, error, at. The latest row
    of a song and step counts; a run is planned from what it shows to be left."""

    SCHEMA = "song_id string, step string, state string, attempt int, seconds double, error string, at timestamp"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def rows(self) -> DataFrame:
        try:
            return self.spark.read.schema(self.SCHEMA).parquet(self.path)
        except Exception as e:
            if "PATH_NOT_FOUND" in str(e):
                return self.spark.createDataFrame([], self.SCHEMA)
            raise

    def record(self, tried: DataFrame, step: str) -> None:
        """``tried``: song_id, state, attempt, seconds, error."""
        tried.select("song_id", F.lit(step).alias("step"), "state", F.col("attempt").cast("int").alias("attempt"), F.col("seconds").cast("double").alias("seconds"), "error", F.current_timestamp().alias("at")).write.mode("append").parquet(self.path)

    def latest(self, step: str) -> DataFrame:
        """A row per song: its last attempt at the step."""
        last = self.rows().where(F.col("step") == step).groupBy("song_id").agg(F.max_by(F.struct("state", "attempt", "seconds", "error", "at"), F.struct("at", "attempt")).alias("r"))
        return last.select("song_id", "r.*")

    def left(self, songs: DataFrame, step: str) -> DataFrame:
        return songs.join(self.latest(step).where("state = 'success'").select("song_id"), "song_id", "left_anti")


def shown(args: list[str]) -> str:
    """A command as it would be typed."""
    return shlex.join(args)


def run_command(args: list[str], timeout_s: float | None = None, content: bytes | None = None) -> str | bytes:
    """Standard output of a command, as bytes if it is given ``content`` to read; a fault carries both outputs whole."""
    done = subprocess.run(args, capture_output=True, input=content, timeout=timeout_s)
    if done.returncode:
        raise RuntimeError(f"{shown(args)} ended with {done.returncode}\n{done.stdout.decode(errors='replace')}\n{done.stderr.decode(errors='replace')}")
    return done.stdout if content is not None else done.stdout.decode()


def health(spark: SparkSession, tools: tuple[str, ...] = ("ffmpeg", "demucs", "basic-pitch")) -> DataFrame:
    """tool, available, path of the optional programs on the driver."""
    import shutil

    return spark.createDataFrame([(t, shutil.which(t) is not None, shutil.which(t)) for t in tools], "tool string, available boolean, path string")
