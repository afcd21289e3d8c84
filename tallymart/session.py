"""Session set-up and the scratch location shared by all executors."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

T = TypeVar("T")
_local_scratch: tempfile.TemporaryDirectory | None = None


def build_session(app_name: str = "tallymart", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators assume.

    Shuffle parallelism on a cluster is left to the submitter and to AQE, which coalesces small
    partitions and splits skewed ones. Call-site capture for every column expression is switched
    off: it doubles the time Python needs to describe a plan.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> None:
    """Pin the session zone; wall-clock columns are zone-less, so any other zone would only add DST gaps."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh directory under the cluster's shared ``spark.checkpoint.dir``.

    Only a ``local`` master without that setting falls back to a temporary folder: on a cluster the
    folder must be reachable from every executor, so an unset value is an error there.
    """
    global _local_scratch
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        if _local_scratch is None:
            _local_scratch = tempfile.TemporaryDirectory(prefix="tallymart-")
        root = _local_scratch.name
    return f"{root.rstrip('/')}/tallymart/{label}-{uuid.uuid4().hex}"


def side_by_side(steps: list[Callable[[], T]]) -> list[T]:
    """The results of steps that do not read one another's, in their order.

    Each step runs its Spark jobs from a thread of its own, so that cores which one job's last tasks leave idle take those of
    another. All steps end before a failure is raised.
    """
    if not steps:
        return []
    inherit = inheritable_thread_target(SparkSession.active())
    with ThreadPoolExecutor(len(steps)) as pool:
        running = [pool.submit(inherit(step)) for step in steps]
    return [step.result() for step in running]
