"""Settings of a run, checked when made. ``None`` for a timeout means no limit."""

from __future__ import annotations

from dataclasses import dataclass

#: Note values that a time signature may count in.
DENOMINATORS = (1, 2, 4, 8, 16, 32)


@dataclass(frozen=True)
class Config:
    analysis_sr: int = 22050
    hop_length: int = 512
    frame_length: int = 2048
    ts_num: int = 4
    ts_den: int = 4
    silence_threshold_db: float = -40.0
    keep_silence_ms: int = 80
    normalize: bool = True
    write_chunks: bool = False
    native_chunks: bool = False
    preprocess: bool = False
    compat: str = "a"
    step_timeout_s: float | None = None
    max_retries: int = 2
    skip_existing: bool = False
    stop_on_error: bool = False

    def __post_init__(self):
        def need(ok: bool, what: str) -> None:
            if not ok:
                raise ValueError(what)

        need(self.analysis_sr > 0, "analysis_sr must be positive")
        need(self.hop_length > 0 and self.frame_length > 0, "hop_length and frame_length must be positive")
        need(self.ts_num > 0, "ts_num must be positive")
        need(self.ts_den in DENOMINATORS, f"ts_den must be one of {DENOMINATORS}")
        need(self.silence_threshold_db <= 0, "silence_threshold_db must not be positive")
        need(self.keep_silence_ms >= 0, "keep_silence_ms must not be negative")
        need(self.compat in ("a", "b"), "compat must be a or b")
        need(self.step_timeout_s is None or self.step_timeout_s > 0, "step_timeout_s must be positive or None")
        need(self.max_retries >= 0, "max_retries must not be negative")
