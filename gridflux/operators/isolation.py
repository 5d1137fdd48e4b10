"""Arrow steps in which a failing tile costs its own rows only.

A step is a function of one Arrow batch.  Where it raises, the batch's parts by key
are tried one by one; rows of a part that raises keep the columns they came with,
have nulls in all others and the exception as ``error``.  Nothing is shuffled for it,
and a batch without a failure is worked through once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridflux.operators.staging import fixed

LONGEST = 200
Work = Callable[[pa.RecordBatch], pa.RecordBatch]


def parts(batch: pa.RecordBatch, key: list[str]) -> list[pa.RecordBatch]:
    """The batch's rows by key, in order of first appearance."""
    places: dict[tuple, list[int]] = {}
    columns = [batch.column(batch.schema.get_field_index(k)).to_pylist() for k in key]
    for i, name in enumerate(zip(*columns, strict=True)):
        places.setdefault(name, []).append(i)
    return [batch] if len(places) < 2 else [batch.take(pa.array(p)) for p in places.values()]


def guarded(work: Work, key: list[str], schema: pa.Schema) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``work`` over batches with a last column ``error``; ``schema`` is what it returns."""
    out_schema = schema.append(pa.field("error", pa.string()))

    def marked(out: pa.RecordBatch) -> pa.RecordBatch:
        columns = [out.column(out.schema.get_field_index(f.name)).cast(f.type) for f in schema]
        return pa.RecordBatch.from_arrays([*columns, pa.nulls(out.num_rows, pa.string())], schema=out_schema)

    def failed(batch: pa.RecordBatch, problem: Exception) -> pa.RecordBatch:
        columns = []
        for f in schema:
            at = batch.schema.get_field_index(f.name)
            columns.append(batch.column(at).cast(f.type) if at >= 0 else pa.nulls(batch.num_rows, f.type))
        text = f"{type(problem).__name__}: {problem}"[:LONGEST]
        return pa.RecordBatch.from_arrays([*columns, pa.array([text] * batch.num_rows, pa.string())], schema=out_schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            try:
                yield marked(work(batch))
                continue
            except Exception as problem:  # noqa: BLE001  any failure of a tile is its own
                several = parts(batch, key)
                if len(several) == 1:
                    yield failed(batch, problem)
                    continue
            for part in several:
                try:
                    yield marked(work(part))
                except Exception as problem:  # noqa: BLE001
                    yield failed(part, problem)

    return run


def map_isolated(rows: DataFrame, work: Work, schema: str, key: list[str]) -> DataFrame:
    """Columns of ``schema`` (with the key's) and ``error`` of ``rows`` through ``work``."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    kinds = to_arrow_schema(_parse_datatype_string(schema))
    return rows.mapInArrow(guarded(work, key, kinds), f"{schema}, error string")


def split_failures(rows: DataFrame, key: list[str]) -> tuple[DataFrame, DataFrame]:
    """(good, errors): rows of keys without any error, and the first message of each of
    the others.  The rows are fixed first, so that both agree and nothing runs twice."""
    kept = fixed(rows)
    errors = kept.where(F.col("error").isNotNull()).groupBy(*key).agg(F.min("error").alias("error"))
    return kept.join(errors.select(*key), key, "left_anti").drop("error"), errors
