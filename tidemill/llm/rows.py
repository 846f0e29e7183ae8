"""What the operators share: narrow inputs, row-wise Python steps, bounded slices."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: rows handed to a row-wise function at a time, so that long texts never pile up
SLICE_ROWS = 256


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) and nothing else, with a NULL text as the empty one.

    Other columns, whatever their names, never enter an operator.
    """
    return docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text")
    )


def map_rows(df: DataFrame, fields: list[tuple[str, str]], function: Callable[[], Callable[[list], list[tuple]]]) -> DataFrame:
    """``function()`` once per task, then its result on slices of rows.

    A slice is a list of tuples in ``df``'s column order; it returns any number of tuples
    in the order of ``fields``.  Arrow batches come and go one at a time.
    """
    schema = T.StructType.fromDDL(", ".join(f"`{n}` {k}" for n, k in fields))
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = function()
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(at, SLICE_ROWS)
                made = step(list(zip(*(c.to_pylist() for c in part.columns), strict=True)))
                if made:
                    columns = zip(*made, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, type=f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow
                    )

    return df.mapInArrow(run, schema)

