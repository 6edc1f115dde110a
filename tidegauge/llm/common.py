"""What the training-data operators share: inputs, Arrow batch bounds, per-text functions, stored tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.registry import Query, query
from tidegauge.session import table

#: Rows and bytes of one Arrow batch, so that a Python worker's memory doesn't follow the text lengths.
BATCH_ROWS = 1000
BATCH_BYTES = 16 << 20


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, which need not have it installed; once per application."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = Path(__file__).resolve().parent.parent
    folder = tempfile.mkdtemp(prefix="package-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    with zipfile.ZipFile(f"{folder}/{package.name}.zip", "w") as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, file.relative_to(package.parent))
    spark.sparkContext.addPyFile(f"{folder}/{package.name}.zip")
    _SHIPPED.add(app)


def for_workers(spark: SparkSession) -> SparkSession:
    """Make Python workers ready: the package at hand, Arrow batches bounded by rows and by bytes."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def llm_query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """``registry.query`` with Python workers made ready."""

    def register(fn: Query) -> Query:
        query(name, sql)(lambda spark, folder: fn(for_workers(spark), folder))
        return fn

    return register


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents")


def text_udf(
    build: Callable[[], Callable[[str | None], tuple]], names: list[str], schema: str
) -> Callable[[Column], Column]:
    """A vectorised function of one text column.

    ``build`` runs once per task and yields the function of one text; its tuples become a struct with ``names``.
    """

    @F.pandas_udf(schema)
    def apply(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        one = build()
        for texts in batches:
            found = [one(t if isinstance(t, str) else None) for t in texts]
            yield pd.DataFrame({n: [f[i] for f in found] for i, n in enumerate(names)}, columns=names, dtype=object)

    return apply


_PER_WORKER: dict[Any, Any] = {}


def once_per_worker(key: Any, make: Callable[[], Any]) -> Any:
    """A value that a Python worker builds once and keeps for later tasks.

    Only the last two are kept, so that an operator's tables go when the next one builds its own.
    """
    if key not in _PER_WORKER:
        while len(_PER_WORKER) >= 2:
            _PER_WORKER.pop(next(iter(_PER_WORKER)))
        _PER_WORKER[key] = make()
    return _PER_WORKER[key]
