"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession


def build_session(app: str = "curbline", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC clocks and adaptive execution.

    Shuffle partition counts are left to the cluster: adaptive execution
    coalesces them, and a number fixed here would be wrong at another scale.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return settle(builder.getOrCreate())


# Trip clocks are wall-clock values, read and printed as UTC. Wide trip rows make
# generated methods that the JVM's compiler refuses above 8000 bytes of code and
# then interprets; below that limit Spark splits the work into smaller methods.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def settle(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings that results and speed depend on."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Settings that hold for the jobs started inside, and are put back after them."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only where that setting is absent and everything runs in one process (tests,
    a laptop) is a local folder made, and remembered in the session so that later
    calls agree. On a cluster the setting is required: a folder of this machine
    would be another folder on every executor.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None
    )
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if not re.fullmatch(r"local(\[.*\])?", master):
        raise ValueError(f"spark.checkpoint.dir must name a folder that all machines of {master} share")
    remembered = spark.conf.get("curbline.scratch.dir", None)
    if not remembered:
        remembered = tempfile.mkdtemp(prefix="curbline-")
        spark.conf.set("curbline.scratch.dir", remembered)
    return remembered


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
