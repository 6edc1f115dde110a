"""Jobs over query, trace and load-test logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.operators.joins import texts_containing, with_user_group
from tidegauge.operators.measures import percentiles
from tidegauge.operators.ordered import Running, earliest, running

# Improvement percentages that count as success and as significant.
SUCCESS_PERCENT, SIGNIFICANT_PERCENT = 10.0, 20.0


def improvement(baseline: DataFrame, current: DataFrame, key: str, total: str) -> DataFrame:
    """Improvement of each query over its baseline in percent, 0 where the baseline is not positive."""
    old, new = F.col("baseline"), F.col("current")
    percent = F.when(old > 0, F.round((old - new) / old * 100, 2)).otherwise(F.lit(0.0))
    joined = baseline.select(key, F.col(total).alias("baseline")).join(
        current.select(key, F.col(total).alias("current")), key
    )
    return joined.withColumn("improvement", percent).withColumns(
        {
            "meets_threshold": F.col("improvement") >= SUCCESS_PERCENT,
            "significant": F.col("improvement") >= SIGNIFICANT_PERCENT,
        }
    )


def read_load_test_logs(spark: SparkSession, glob: str, schema: str) -> DataFrame:
    """All load-test CSV logs with start times cut to the second."""
    rows = spark.read.schema(schema).option("header", True).csv(glob)
    return rows.withColumn("start_time_dt", F.date_trunc("second", F.to_timestamp("start_time_dt")))


def with_second_statistics(logs: DataFrame, second: str, duration: str) -> DataFrame:
    """Each row with mean, p50 and p90 of the durations that started in its second."""
    exact = percentiles(logs, [second], duration, {"p50": 0.5, "p90": 0.9})
    # Summed as decimals, so that the mean does not depend on the order of the rows.
    total = F.sum(F.col(duration).cast("decimal(18,6)")).cast("double")
    mean = logs.groupBy(second).agg((total / F.count(duration)).alias("mean"))
    return logs.join(exact, second).join(mean, second)


def query_list(
    events: DataFrame,
    by: Sequence[str],
    order: Sequence[Column],
    name: str,
    title_event: str,
    query_event: str,
    title: str,
    text: str,
) -> DataFrame:
    """Query events of a recording, each with the title of the last visual before it."""
    carried = running(events, by, order, visual=Running("last", F.when(F.col(name) == title_event, F.col(title))))
    return carried.filter(F.col(name) == query_event).select(*by, "visual", F.col(text).alias("query_text"))


def filtered_trace(
    trace: DataFrame, run: str, event: str, session: str, order: Sequence[str], prop: str, begin: str = "QueryBegin"
) -> DataFrame:
    """Rows of the first session that begins a query in each run, with the begin event's property."""
    begins = trace.filter(F.col(event) == begin).select(
        run, *order, F.col(session).alias("_session"), F.col(prop).alias("begin_property")
    )
    first = earliest(begins, [run], [F.col(c) for c in order]).select(
        F.col(run).alias("_run"), "_session", "begin_property"
    )
    own = (F.col(run) == F.col("_run")) & F.col(session).eqNullSafe(F.col("_session"))
    return trace.join(first, own).drop("_run", "_session")


def object_usage(
    logs: DataFrame, key: str, text: str, objects: DataFrame, obj: str, hour: Column, user: str, members: DataFrame, report: str, default_group: str
) -> DataFrame:
    """Queries per object, hour, user group and report; an object counts when its name is in the text."""
    timed = logs.withColumn("as_of_hour", hour)
    grouped = with_user_group(timed, members, user, default_group)
    hits = texts_containing(grouped.select(key, text, "as_of_hour", "user_group", report), key, text, objects, obj)
    return hits.groupBy(obj, "as_of_hour", "user_group", report).agg(F.count(F.lit(1)).alias("query_count"))


def cold_cache(logs: DataFrame, text: str, pattern: str, ok: Column, duration: str, cpu: str) -> DataFrame:
    """Average duration and CPU of successful probes per column named in the query text."""
    column = F.nullif(F.regexp_extract(F.col(text), pattern, 1), F.lit(""))
    probes = logs.filter(ok).withColumn("column_name", column).filter(F.col("column_name").isNotNull())
    return probes.groupBy("column_name").agg(
        F.avg(duration).alias("duration"), F.avg(cpu).alias("cpu"), F.count(F.lit(1)).alias("probes")
    )
