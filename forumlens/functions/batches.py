"""Texts some at a time: slices of a column as Arrow arrays, and their words as numbers."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F


def by_slices(of_some: Callable[[pa.Array], pa.Array], arrow_type: pa.DataType, spark_type: str, at_once: int):
    """A function of a column that takes some texts at a time; a filter on its result makes no copy of it."""

    def work(texts: pa.Array) -> pa.Array:
        return in_slices(of_some, texts, arrow_type, at_once)

    work.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(work, spark_type).asNondeterministic()


def in_slices(of_some: Callable[[pa.Array], pa.Array], texts: pa.Array, arrow_type: pa.DataType, at_once: int) -> pa.Array:
    parts = [of_some(texts.slice(low, at_once)) for low in range(0, len(texts), at_once)]
    return pa.concat_arrays(parts) if parts else pa.array([], arrow_type)


def translated(texts: pa.Array, table: bytes) -> pa.Array:
    """Texts with every byte replaced as a table says; of a slice, only its own bytes are worked through."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    signs = texts.buffers()[2]
    own = bytes(memoryview(signs)[offsets[0] : offsets[-1]]).translate(table) if signs else b""
    valid = pa.py_buffer(np.packbits(np.asarray(texts.is_valid()), bitorder="little").tobytes()) if texts.null_count else None
    return pa.Array.from_buffers(texts.type, len(texts), [valid, pa.py_buffer((offsets - offsets[0]).tobytes()), pa.py_buffer(own)])


def coded(texts: pa.Array, wanted: Callable[[pa.Array], pa.Array] | None = None) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Row and code of each wanted word of texts, in order, and the words that codes stand for."""
    found = pc.ascii_split_whitespace(texts)
    row = np.repeat(np.arange(len(texts)), np.asarray(pc.fill_null(pc.list_value_length(found), 0)))
    encoded = found.flatten().dictionary_encode()
    words = encoded.dictionary
    kept = np.asarray(pc.not_equal(words, "") if wanted is None else wanted(words), bool)
    if not kept.all():
        code = np.where(kept, np.cumsum(kept) - 1, -1)[np.asarray(encoded.indices)]
        return row[code >= 0], code[code >= 0], words.filter(pa.array(kept))
    return row, np.asarray(encoded.indices, np.int64), words
