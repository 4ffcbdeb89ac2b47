"""Shared helpers: columns computed from whole texts inside Arrow tasks."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

#: Rows computed at a time: bounds a worker's memory also where texts are long.
ROWS_AT_ONCE = 128
#: Bytes of text computed at a time where an operator asks for more rows; one text is never cut.
BYTES_AT_ONCE = 16_000_000

_STORE = "_linksieve_llm_worker"

Compute = Callable[[list], list]


def column(name: str):
    """The column of exactly this name, also with dots or spaces in it."""
    return F.col("`" + name.replace("`", "``") + "`")


def remembered(name, make: Callable[[], object]):
    """What ``make`` gives, kept under ``name`` as long as this Python process, which Spark reuses from task to task.

    One operator's memory is kept at a time: stages that follow each other run in the same processes, and what
    all of them remember would add up.
    """
    store = vars(sys.modules.setdefault(_STORE, types.ModuleType(_STORE)))
    held = store.setdefault("held", {})
    if name not in held:
        held.clear()
        held[name] = make()
    return held[name]


def give_back() -> None:
    """Return to the system what Arrow has freed but holds: about 100 MB a process after batches of long texts."""
    pa.default_memory_pool().release_unused()


def text_bounds(texts: pa.Array, rows: int, most: int = BYTES_AT_ONCE) -> list[int]:
    """Where to cut ``texts``: at most ``rows`` and, beyond one text, ``most`` bytes to a part."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    bounds = [0]
    while bounds[-1] < len(texts):
        start = bounds[-1]
        before = ends[start - 1] if start else 0
        fits = int(np.searchsorted(ends, before + most, side="right"))
        bounds.append(max(start + 1, min(start + rows, fits)))
    return bounds


def text_columns(
    df: DataFrame,
    make: Callable[[], Compute],
    fields: list[StructField],
    text: str = "text",
    keep: list[str] | None = None,
    rows: int = ROWS_AT_ONCE,
) -> DataFrame:
    """``keep`` (default: all columns) and new ``fields`` computed from whole texts.

    ``make`` runs once in a task and returns the function that turns a list of texts
    (``None`` for null) into one list per field. A kept column with the name of a field,
    in whatever case, is replaced by the field. An empty table gives an empty one. The function gets
    at most ``rows`` texts at a time, fewer where they are long.
    """
    new = {f.name.lower() for f in fields}
    kept = [c for c in (df.columns if keep is None else keep) if c.lower() not in new]
    # by position from here on, so no name can clash with another
    source = df.select(*[column(c) for c in kept], column(text).cast("string").alias("\x00text"))
    schema = StructType([*source.schema.fields[:-1], *fields])
    arrow = to_arrow_schema(schema)

    def run(batches):
        compute = make()
        for batch in batches:
            bounds = [*range(0, batch.num_rows, rows), batch.num_rows]
            if rows > ROWS_AT_ONCE:
                bounds = text_bounds(batch.columns[-1], rows)
            for start, end in zip(bounds, bounds[1:]):
                columns = batch.slice(start, end - start).columns
                made = compute(columns[-1].to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [
                        *(c.cast(f.type) if c.type != f.type else c for c, f in zip(columns[:-1], arrow)),
                        *(pa.array(v, f.type) for v, f in zip(made, list(arrow)[len(columns) - 1 :])),
                    ],
                    schema=arrow,
                )
            give_back()

    return source.mapInArrow(run, schema)
