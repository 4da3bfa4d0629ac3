"""Helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: White space of all word contracts: space and the control characters 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under internal names; a missing one is NULL.

    Everything else a table carries, under whatever name, stays out of the operator's way.
    """
    have = set(df.columns)
    return df.select(*[
        (df[source] if source in have else F.lit(None)).cast(kind).alias(name)
        for name, (source, kind) in {
            k: v.rsplit(":", 1) for k, v in columns.items()}.items()])


def value(df: DataFrame, name: str, kind: str) -> Column:
    """A column of a table, NULL where it has none of that name."""
    return (df[name] if name in df.columns else F.lit(None)).cast(kind)


def row_key(docs: DataFrame) -> Column:
    """A row is known by its id and text: rows that share an id stay apart, and so do those without one."""
    return F.xxhash64(value(docs, "doc_id", "bigint"), value(docs, "text", "string"))


def unit_hash(*columns: Column, seed: int = 0) -> Column:
    """A reproducible number in [0, 1) for a row's values."""
    h = F.xxhash64(F.lit(seed), *columns)
    return F.shiftrightunsigned(h, 11).cast("double") / F.lit(float(1 << 53))


def parallel(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def slices(batch: pa.RecordBatch, column: int, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of about ``limit`` text bytes (always one row at least), so that what is
    derived from a batch stays small however many long texts it holds."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0)).astype(np.int64)
    part = (np.cumsum(sizes) - sizes) // limit
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def runs(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Consecutive rows with equal keys, across batch borders; the input is sorted by them."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [np.asarray(batch.column(k)) for k in keys]
        change = np.zeros(batch.num_rows - 1, dtype=bool)
        for c in columns:
            change |= c[1:] != c[:-1]
        cuts = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            key = tuple(c[a] for c in columns)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = key
    if held:
        yield pa.Table.from_batches(held)
