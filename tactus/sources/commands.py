"""External programs over files: a file's bytes go to a program's standard input, what it writes is the new content.

So other containers become WAV files (a decoder), mixes become stems or stems become MIDI files (a model's program), where the program is on every executor. A file is
tried again after a fault; a fault that stays is the row's error. A worker process stops starting a program that failed many times in a row, and tries it again after a rest."""

from __future__ import annotations

import subprocess
import time
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from tactus.operators.batch import CircuitBreaker, RetryError, retry, run_command
from tactus.sources import audio

_BREAKERS: dict[tuple[str, ...], CircuitBreaker] = {}
FAILURES, REST_S = 5, 60.0


def through_command(files: DataFrame, args: tuple[str, ...], timeout_s: float | None = 300.0, retries: int = 1) -> DataFrame:
    """The columns of ``files`` with the content that ``args`` makes of it, error and seconds; content is null where there is an error. Null content goes in as no bytes."""
    kept = [c for c in files.columns if c != "content"]
    kinds = dict(files.dtypes)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        breaker = _BREAKERS.setdefault(tuple(args), CircuitBreaker(FAILURES, REST_S))
        for pdf in parts:
            rows = []
            for content in pdf["content"]:
                began = time.perf_counter()
                try:
                    work = lambda content=content: run_command(list(args), timeout_s, bytes(content or b""))
                    made, error = retry(lambda work=work: breaker.call(work), retries, base=0.05, faults=(RuntimeError, OSError, subprocess.TimeoutExpired)), None
                except (RetryError, OSError) as e:
                    made, error = None, str(e.__cause__ or e).strip().splitlines()[0]
                rows.append((made, error, time.perf_counter() - began))
            yield pd.concat([pdf[kept].reset_index(drop=True), pd.DataFrame(rows, columns=["content", "error", "seconds"])], axis=1)

    return files.mapInPandas(run, ", ".join(f"{c} {kinds[c]}" for c in kept) + ", content binary, error string, seconds double")


def read_converted(spark: SparkSession, path: str, pattern: str, args: tuple[str, ...], compat: str = "a") -> DataFrame:
    """Signals of files that ``args`` turns into WAV; rows with an error have no samples."""
    made = through_command(audio.read_files(spark, path, pattern, compat), args)
    good = audio.signals_of(made.where("error is null"))
    return good.unionByName(made.where("error is not null").select("song_id", "stem", "error"), allowMissingColumns=True)
