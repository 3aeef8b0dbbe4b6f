"""Session factory and the runtime settings the library relies on."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from functools import lru_cache

from pyspark.sql import SparkSession

# Only settings that may change at run time; cluster sizing stays with the submitter.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A mart with a few hundred segments keeps its percentile sketches in the hash map
    # instead of sorting the whole input once it passes 128 segments.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "1024",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app_name: str, master: str | None = None, **extra: str) -> SparkSession:
    # Call-site capture on every column expression costs more than building the plan does.
    builder = SparkSession.builder.appName(app_name).config(
        "spark.python.sql.dataFrameDebugging.enabled", "false"
    )
    if master:
        builder = builder.master(master)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return tune(builder.getOrCreate())


@lru_cache(maxsize=1)
def _single_machine_root() -> str:
    return tempfile.mkdtemp(prefix="surveylake-")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder under the shared folder the cluster names in ``spark.checkpoint.dir``.

    Only on a single machine (a local master) a temporary folder stands in where that setting is
    absent; on a cluster its absence is an error, as executors would write to their own disks.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = _single_machine_root()
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Run-time settings for the actions inside the block; the former values come back after it."""
    former = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in former.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
