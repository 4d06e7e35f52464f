"""Command line: ``spark-submit tactus/cli.py WAV_FOLDER OUT [--midi FOLDER] ...``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from tactus.config import Config
from tactus.plans import song


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(description="Songs to beat grids, aligned notes and bar features.")
    p.add_argument("wav")
    p.add_argument("out")
    p.add_argument("--midi")
    p.add_argument("--sample-rate", type=int, default=22050)
    p.add_argument("--ts-num", type=int, default=4)
    p.add_argument("--ts-den", type=int, default=4)
    p.add_argument("--preprocess", action="store_true")
    p.add_argument("--silence-db", type=float, default=-40.0)
    p.add_argument("--compat", choices=("a", "b"), default="a")
    p.add_argument("--write-chunks", action="store_true")
    p.add_argument("--native-chunks", action="store_true", help="chunk files with all channels, else their mean")
    p.add_argument("--skip-existing", action="store_true")
    p.add_argument("--stop-on-error", action="store_true")
    p.add_argument("--max-retries", type=int, default=2)
    p.add_argument("--step-timeout", type=float)
    return p


def main(args: list[str] | None = None) -> int:
    a = parser().parse_args(args)
    config = Config(analysis_sr=a.sample_rate, ts_num=a.ts_num, ts_den=a.ts_den, preprocess=a.preprocess, silence_threshold_db=a.silence_db, compat=a.compat, write_chunks=a.write_chunks, native_chunks=a.native_chunks, skip_existing=a.skip_existing, stop_on_error=a.stop_on_error, max_retries=a.max_retries, step_timeout_s=a.step_timeout)
    spark = SparkSession.builder.appName("tactus").getOrCreate()
    song.run(spark, a.wav, a.midi, a.out, config)
    return int(not spark.read.json(f"{a.out}/results", "status string").where("status = 'failed'").isEmpty())


if __name__ == "__main__":
    raise SystemExit(main())
