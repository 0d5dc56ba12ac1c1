"""Session helpers."""

from __future__ import annotations

import logging
import os
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = str(Path(__file__).resolve().parent.parent)


def ship(spark: SparkSession) -> None:
    """Python workers get this package's parent folder on their path, beside what is set already; on a
    cluster the package is installed or sent with --py-files, and a missing folder does no harm."""
    env = spark.sparkContext.environment
    path = env.get("PYTHONPATH", "")
    if ROOT not in path.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, path]))


def setup_logging(file: str | None = None, level: int = logging.INFO) -> logging.Logger:
    """The library's logger with time, level and message on the console and, if named, in a file of the
    driver (R7). Called again, it replaces its handlers."""
    log = logging.getLogger("weft")
    for old in list(log.handlers):
        log.removeHandler(old)
        old.close()
    if file:
        Path(file).parent.mkdir(parents=True, exist_ok=True)
    for handler in (logging.StreamHandler(), *([logging.FileHandler(file, encoding="utf-8")] if file else [])):
        handler.setFormatter(logging.Formatter("%(asctime)s %(levelname)s %(message)s"))
        log.addHandler(handler)
    log.setLevel(level)
    return log
