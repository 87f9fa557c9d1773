"""The few things that depend on the session: lineage cuts, scratch space, size checks."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

# A build side is broadcast up to so many rows and so many bytes of values.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64_000_000
# A measured table of narrow rows is read in tasks of so many, however many wrote it.
ROWS_A_TASK = 100_000


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    A session without that setting needs a folder set by ``setCheckpointDir``, which tests, the
    benchmark and the entry module do for local sessions.
    """
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not folder:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for an intermediate table in the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably, so later stages survive the loss of an executor."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str, **measures: Column) -> tuple[DataFrame, dict]:
    """``df`` written as Parquet to the shared folder, and aggregates gathered by the same job.

    For large tables of plain columns: smaller than a checkpoint, and later scans read only the
    columns they need.
    """
    path, seen = scratch_path(df.sparkSession, name), Observation()
    (df.observe(seen, *[c.alias(n) for n, c in measures.items()]) if measures else df).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), seen.get if measures else {}


def cut_and_measure(df: DataFrame, **measures: Column) -> tuple[DataFrame, dict]:
    """:func:`cut_lineage`, with aggregates over the rows gathered by the same job."""
    seen = Observation()
    cut = cut_lineage(df.observe(seen, *[c.alias(name) for name, c in measures.items()]))
    return cut, seen.get


def in_few_tasks(df: DataFrame, n: int) -> DataFrame:
    """``df`` of narrow rows in as few tasks as ``n`` rows fill; nothing is shuffled for it.

    A shuffle of few rows from many tasks costs files, events and time for each of them.
    """
    return df.coalesce(1 + n // ROWS_A_TASK)


def cut_to_few_tasks(df: DataFrame) -> DataFrame:
    """:func:`cut_lineage` of narrow rows, read in as few tasks as they fill."""
    cut, seen = cut_and_measure(df, n=F.count(F.lit(1)))
    return in_few_tasks(cut, seen["n"])


def _bytes(df: DataFrame) -> Column:
    """Bytes of all values as text, summed."""
    return F.sum(F.octet_length(F.to_json(F.struct(*df.columns))))


def size_measures(columns: list[str]) -> dict[str, Column]:
    """Measures of :func:`cut_and_measure` that :func:`is_small` judges a table by."""
    return {"n": F.count(F.lit(1)), "size": F.coalesce(F.sum(F.octet_length(F.to_json(F.struct(*columns)))), F.lit(0))}


def is_small(seen: dict, max_rows: int = BROADCAST_ROWS) -> bool:
    return seen["n"] <= max_rows and seen["size"] <= BROADCAST_BYTES


def fits(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether a stored table may be broadcast; counted by all tasks, so no rows move."""
    if df.count() > max_rows:  # the bytes of a large table need not be summed
        return False
    seen = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(_bytes(df), F.lit(0)).alias("size")).first()
    return seen["n"] <= max_rows and seen["size"] <= max_bytes


def broadcast_if_small(
    df: DataFrame, max_rows: int = BROADCAST_ROWS, stored: bool = False, max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Hint a broadcast when ``df`` is shown to be small, else leave the join to AQE.

    A table made by aggregation is computed once: the job that stores it measures it as well.
    ``stored`` says that ``df`` reads a stored table, so that measuring it is cheap.
    """
    if stored:
        return F.broadcast(df) if fits(df, max_rows, max_bytes) else df
    kept, seen = cut_and_measure(df, n=F.count(F.lit(1)), size=F.coalesce(_bytes(df), F.lit(0)))
    small = seen["n"] <= max_rows and seen["size"] <= max_bytes
    return F.broadcast(in_few_tasks(kept, seen["n"])) if small else kept
