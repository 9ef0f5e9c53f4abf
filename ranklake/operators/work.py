"""A user function over work items, and the state that its outcomes advance."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from ranklake.operators.joins import mark
from ranklake.operators.normalize import classify, is_done
from ranklake.schemas import ATTEMPTS
from ranklake.session import scratch_path

Reply = tuple[int | None, str | None, list[dict]]

#: Replies that a task holds before it hands them on.
BUFFER_BYTES = 8 << 20


def _bytes(value) -> int:
    """About how much memory a value takes."""
    if isinstance(value, dict):
        return 100 + sum(_bytes(v) for v in value.values())
    if isinstance(value, (list, tuple)):
        return 60 + sum(map(_bytes, value))
    return 50 + (len(value) if isinstance(value, (str, bytes)) else 0)


def _task(fn: Callable[[dict], Reply], key: list[str], arrow_schema, attempts: int):
    def run(batches):
        import pyarrow as pa

        limited = False
        for batch in batches:
            rows, held = [], 0  # replies not handed on yet, and about how many bytes they hold
            for item in batch.to_pylist():
                name = {k: item[k] for k in key}
                status, wait, records, tries, failure = None, None, [], 0, None
                while not limited and tries < attempts:
                    tries += 1
                    try:
                        status, wait, records = fn(item)
                    except (ConnectionError, TimeoutError):
                        status, wait, records = None, None, []
                    except Exception as problem:  # the item fails, the others go on
                        status, wait, records = None, None, []
                        failure = f"{type(problem).__name__}: {problem}"
                        break
                    if status is not None and status not in (500, 502, 503, 504):
                        break
                limited = limited or status == 429
                name["status"], name["retry_after"], name["attempts"], name["failure"] = status, wait, tries, failure
                name["records"] = records if status is not None and status < 400 else []
                rows.append(name)
                held += 200 + sum(_bytes(r) for r in name["records"])
                if held >= BUFFER_BYTES:
                    yield pa.RecordBatch.from_pylist(rows, schema=arrow_schema)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=arrow_schema)

    return run


def map_work(
    work: DataFrame,
    fn: Callable[[dict], Reply],
    records: StructType,
    key: list[str],
    parts: int | None = None,
    attempts: int = ATTEMPTS,
    path: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Call ``fn`` on every work item; return its records and one outcome per item.

    ``fn`` gets the item as a dict and returns a status, a retry-after text and records.
    A transient status or transport error is tried again, ``attempts`` times in all. A part
    that meets status 429 leaves the rest of its items ``pending``. Any other exception makes
    that item an ``error``. ``key`` must be unique in ``work``.

    The replies are written once to ``path`` (in the shared folder unless given) and both
    results read from there, so no item is called again for the second one.
    """
    if attempts < 1:
        raise ValueError(f"attempts must be at least 1, got {attempts}")
    spark = work.sparkSession
    schema = StructType(
        [
            *[work.schema[k] for k in key],
            StructField("status", IntegerType()),
            StructField("retry_after", StringType()),
            StructField("attempts", IntegerType()),
            StructField("failure", StringType()),
            StructField("records", ArrayType(records)),
        ]
    )
    # A number of its own, as items are too small for Spark to keep them apart.
    spread = work.repartition(parts or int(spark.conf.get("spark.sql.shuffle.partitions")), *key)
    path = path or scratch_path(spark, "replies")
    task = _task(fn, list(key), to_arrow_schema(schema), attempts)
    spread.mapInArrow(task, schema).write.mode("overwrite").parquet(path)
    replies = spark.read.schema(schema).parquet(path)
    found = replies.select(*key, F.inline("records"))
    outcomes = classify(replies.drop("records")).withColumn(
        "outcome",
        F.when(F.col("attempts") == 0, "pending")
        .when(F.col("failure").isNotNull(), "error")
        .otherwise(F.col("outcome")),
    )
    return found, outcomes


def advance(
    state: DataFrame, outcomes: DataFrame, key: str, values: dict, spread: list[str] | None = None
) -> DataFrame:
    """Set ``values`` on the state rows whose item is done; all others stay as they are.

    ``spread`` is needed where an item has many state rows.
    """
    return mark(state, outcomes.where(is_done()), key, values, spread)
