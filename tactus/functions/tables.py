"""Feature extractors as SQL table functions: samples in, a record out."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf

from tactus.functions import dsp

#: Extractors of the library by the names of their SQL functions: samples and rate to the fields of a record.
RECORD = "rms double, zcr double, energy double, spectral_centroid_mean double, spectral_centroid_std double, spectral_rolloff_mean double, spectral_rolloff_std double, spectral_bandwidth_mean double, mfcc_mean array<double>, mfcc_std array<double>, chroma_mean array<double>"
VARIANT_RECORD = ", ".join(f"{c} double" for c in dsp.VARIANT_FIELDS)
EXTRACTORS = {"signal_features": (dsp.features, RECORD), "variant_features": (dsp.variant_features, VARIANT_RECORD)}


def table_function(extractor: Callable[[np.ndarray, int], dict], record: str, arrow: bool = True):
    """A table function (samples, sample_rate) that gives one row of ``record``: what ``extractor`` makes of the samples. Null samples count as none; a null rate, or one that isn't positive, gives no row."""
    fields = [c.split()[0] for c in record.split(", ")]

    class Extract:
        def eval(self, samples: list, sample_rate: int) -> Iterator[tuple]:
            if sample_rate is not None and sample_rate > 0:
                x = np.zeros(0) if samples is None else np.asarray([0.0 if v is None else v for v in samples], float)
                found = extractor(x, int(sample_rate))
                yield tuple(v if isinstance(v := found[c], list) else float(v) for c in fields)

    return udtf(Extract, returnType=record, useArrow=arrow)


def register(spark: SparkSession, **more: tuple[Callable[[np.ndarray, int], dict], str]) -> list[str]:
    """Registers the library's extractors, and ``more`` (name=(extractor, record)), for use as ``SELECT ... FROM t, LATERAL name(samples, sample_rate)``; returns the names."""
    every = EXTRACTORS | more
    for name, (extractor, record) in every.items():
        spark.udtf.register(name, table_function(extractor, record))
    return list(every)
