"""Row-wise operators over Arrow batches: results are added to the rows of a DataFrame."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docklens.llm import words

Result = dict[str, np.ndarray | pa.Array]


def add_columns(
    docs: DataFrame,
    inputs: list[str],
    schema: str,
    compute: Callable[..., Result],
    keep: list[str] | None = None,
) -> DataFrame:
    """The columns ``keep`` (all, if None) of ``docs`` and those of ``schema``.

    ``compute`` gets the arrays of ``inputs`` of one batch and returns one array for each
    column of ``schema``. An input column of the same name, in any letter case, is replaced.
    """
    added = T.StructType.fromDDL(schema)
    new = {f.name.lower() for f in added}
    kept = [c for c in (docs.columns if keep is None else keep) if c.lower() not in new]
    # Python functions do not take every column name
    plain = {c: f"_{n}" for n, c in enumerate(dict.fromkeys([*kept, *inputs]))}
    read = docs.select(*(F.col(f"`{c}`").alias(name) for c, name in plain.items()))
    passed = [plain[c] for c in kept]
    out = T.StructType([read.schema[name] for name in passed] + added.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = compute(*(batch.column(plain[c]) for c in inputs))
            yield pa.RecordBatch.from_arrays(
                [batch.column(n) for n in passed] + [_array(made[f.name]) for f in added],
                names=out.names,
            )

    return read.mapInArrow(run, out).toDF(*kept, *added.names)


def _array(values: np.ndarray | pa.Array) -> pa.Array:
    if isinstance(values, np.ndarray):
        return pa.array(values)
    return values.combine_chunks() if isinstance(values, pa.ChunkedArray) else values


def set_aside(docs: DataFrame, schema: str) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with columns named like one of ``schema`` renamed, and their new names."""
    new = {f.name.lower() for f in T.StructType.fromDDL(schema)}
    names = {c: f"_own_{c}" for c in docs.columns if c.lower() in new}
    return docs.withColumnsRenamed(names), {c: names.get(c, c) for c in docs.columns}


def by_slice(
    texts: pa.Array, compute: Callable[[np.ndarray, np.ndarray], Result], empty: Result
) -> Result:
    """Run ``compute`` (bytes, offsets) on slices of the batch and join the pieces."""
    parts = [compute(values, offsets) for _, values, offsets in words.slices(texts)] or [empty]
    out = {}
    for name in parts[0]:
        pieces = [p[name] for p in parts]
        out[name] = (
            np.concatenate(pieces)
            if isinstance(pieces[0], np.ndarray)
            else pa.chunked_array(pieces).combine_chunks()
        )
    return out


def strings(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Texts from their bytes."""
    return pa.LargeStringArray.from_buffers(
        len(offsets) - 1,
        pa.py_buffer(np.ascontiguousarray(offsets, np.int64)),
        pa.py_buffer(np.ascontiguousarray(values)),
    ).cast(pa.string())
