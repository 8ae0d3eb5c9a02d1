"""Columns computed from a text column in Arrow batches, beside the columns that the rows have."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tallyframe.llm.bytewords import BATCH_BYTES, released_memory, sub_batches
from tallyframe.llm.shared import bounded_batches

#: Takes texts as bytes, gives a list of values for each added column.
Compute = Callable[[list[bytes]], Iterable[list]]


def with_text_columns(df: DataFrame, text_col: str, fields: list[T.StructField], factory: Callable[[], Compute], batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """df with ``fields`` added; ``factory`` runs once a task and gives the function that computes them.

    A null text counts as empty. Columns of df that have the name of an added one are replaced.
    No row is dropped and nothing is shuffled; a task holds one Arrow batch and ``batch_bytes`` of
    texts (or a single longer text) at a time. A function with an attribute ``close`` has that called at the task's end.
    """
    bounded_batches(df.sparkSession)
    added = {f.name for f in fields}
    kept = [f for f in df.schema.fields if f.name not in added or f.name == text_col]
    carried = [f.name for f in kept if f.name not in added]
    types = [to_arrow_type(f.dataType) for f in fields]
    names = [*carried, *(f.name for f in fields)]
    at = [f.name for f in kept].index(text_col)
    carry = [i for i, f in enumerate(kept) if f.name not in added]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = None
        for batch in batches:
            compute = compute or factory()
            for first, texts in sub_batches(batch.column(at), batch_bytes):
                part = batch.slice(first, len(texts))
                made = [x if isinstance(x, pa.Array) else pa.array(x, t) for x, t in zip(compute(texts), types)]
                yield pa.RecordBatch.from_arrays([part.column(i) for i in carry] + made, names)
        if compute is not None:
            getattr(compute, "close", bool)()
        released_memory()

    schema = T.StructType([f for f in kept if f.name not in added] + list(fields))
    return df.select(*[df[f"`{f.name}`"] for f in kept]).mapInArrow(work, schema)
