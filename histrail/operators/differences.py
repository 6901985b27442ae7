"""Differences between two copies of a dataset, field by field."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import shuffle_width

#: Rows of one hash bucket, at most about this many on each side; a bucket is one Arrow table in one task.
ROWS_PER_BUCKET = 50_000


def _key_text(keys: Sequence[str]) -> Column:
    """An unambiguous text of the key: each part with its length, null apart from the empty string."""
    parts = [F.coalesce(F.concat(F.length(F.col(k).cast("string")), F.lit(":"), F.col(k).cast("string")), F.lit("~")) for k in keys]
    return F.concat_ws("|", *parts)


def _one_row_per_key(df: DataFrame, keys: Sequence[str], fields: Sequence[str], buckets: int, unique: bool) -> DataFrame:
    """Exact copies collapse on the map side; of rows that disagree under one key the least stands for the key and is marked.
    Keys that are ``unique`` already need no shuffle of their own."""
    text = _key_text(keys)
    if unique:
        columns, split = [F.col(f) for f in fields], F.lit(False)
    else:
        row = F.struct(*[F.col(f) for f in fields])
        df = df.groupBy(*keys).agg(F.min(row).alias("__least"), F.max(row).alias("__most"))
        columns, split = [F.col("__least")[f].alias(f) for f in fields], ~F.col("__least").eqNullSafe(F.col("__most"))
    return df.select(
        F.pmod(F.xxhash64(text), F.lit(buckets)).cast("int").alias("__bucket"), F.xxhash64(text, F.lit(7)).alias("__hash"), text.alias("__key"),
        *[F.col(k) for k in keys], *columns, split.alias("__split"),
    )


def _align(left: pa.Table, right: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of equal keys on both sides, by sorted search over the key hashes and a check of the keys themselves."""
    lh, rh = (t.column("__hash").to_numpy() for t in (left, right))
    order = np.argsort(rh, kind="stable")
    at = np.searchsorted(rh[order], lh)
    inside = at < len(rh)
    rows = order[np.where(inside, at, 0)] if len(rh) else np.zeros(len(lh), dtype=np.int64)
    same_hash = inside & (rh[rows] == lh) if len(rh) else np.zeros(len(lh), dtype=bool)
    same_key = np.zeros(len(lh), dtype=bool)
    hit = np.flatnonzero(same_hash)
    if len(hit):
        equal = pc.equal(left.column("__key").take(pa.array(hit)), right.column("__key").take(pa.array(rows[hit])))
        same_key[hit] = equal.to_numpy(zero_copy_only=False)
    astray = np.flatnonzero(same_hash & ~same_key)
    if len(astray):  # two keys of one hash: look these up by the key itself
        places = {k: i for i, k in enumerate(right.column("__key").to_pylist())}
        keys = left.column("__key")
        for i in astray:
            j = places.get(keys[int(i)].as_py())
            if j is not None:
                rows[i], same_key[i] = j, True
    found = np.flatnonzero(same_key)
    return found, rows[found]


def _differ(a: pa.ChunkedArray, b: pa.ChunkedArray) -> np.ndarray:
    """Null equals null; null differs from any value."""
    unequal = pc.fill_null(pc.not_equal(a, b), False).to_numpy(zero_copy_only=False)
    return unequal | pc.xor(pc.is_null(a), pc.is_null(b)).to_numpy(zero_copy_only=False)


def diff_copies(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    fields: Sequence[str],
    *,
    missing_left: str = "missing_left",
    missing_right: str = "missing_right",
    split_left: str | None = None,
    split_right: str | None = None,
    buckets: int | None = None,
    rows: int | None = None,
    unique_left: bool = False,
    unique_right: bool = False,
) -> DataFrame:
    """Rows missing on either side, and one row for each field that differs.

    Returns ``keys + [difference, left_value, right_value]`` with the values as text. ``difference`` is
    ``missing_left``, ``missing_right`` or the field's name. Both sides need ``keys`` and ``fields`` of equal types;
    further columns are ignored, whatever their names.

    Both sides are reduced to one row a key before anything is shuffled by bucket, so repeated rows of a hot key never
    meet in one task. Then hash buckets of both sides are cogrouped as Arrow tables: keys are aligned by sorted search,
    columns compared through null-aware masks, and only the masked cells are put out. ``buckets`` grows with ``rows``
    (the larger side's count if not given), so that a bucket keeps its size.

    Cases: null keys are keys like any other and equal each other. Null equals null and differs from any value, the
    empty string included. Exact copies of a row are one row. Where rows of one key disagree on one side, the least
    row by ``fields`` is compared, and ``split_left`` / ``split_right``, if given, name a further difference row that
    reports it. ``unique_left`` / ``unique_right`` promise that no key has two rows there. Two empty sides give no rows; one empty side gives every key of the other.
    """
    spark = left.sparkSession
    keys, fields = list(keys), list(fields)
    clash = [c for c in keys + fields if c.startswith("__")]
    if clash:
        raise ValueError(f"names starting with two underscores are taken: {clash}")
    if buckets is None:
        n = rows if rows is not None else max(left.select(keys[0]).count(), right.select(keys[0]).count())
        buckets = max(shuffle_width(spark), -(-n // ROWS_PER_BUCKET))
    a, b = (_one_row_per_key(df.select(*keys, *fields), keys, fields, buckets, u) for df, u in ((left, unique_left), (right, unique_right)))
    key_fields = [a.schema[k] for k in keys]
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in key_fields] + [T.StructField(x, T.StringType()) for x in ("difference", "left_value", "right_value")])
    names = {"left": missing_left, "right": missing_right}

    def compare(ta: pa.Table, tb: pa.Table) -> pa.Table:
        found_a, found_b = _align(ta, tb)
        parts: list[pa.Table] = []

        def put(source: pa.Table, what: str, old=None, new=None) -> None:
            if source.num_rows:
                none = pa.nulls(source.num_rows, pa.string())
                columns = {k: source.column(k) for k in keys}
                texts = [none if v is None else pc.cast(v, pa.string()) for v in (old, new)]
                parts.append(pa.table({**columns, "difference": pa.array([what] * source.num_rows, pa.string()), "left_value": texts[0], "right_value": texts[1]}))

        for side, table, found in (("right", ta, found_a), ("left", tb, found_b)):
            rest = np.ones(table.num_rows, dtype=bool)
            rest[found] = False
            put(table.filter(pa.array(rest)), names[side])
        for table, what in ((ta, split_left), (tb, split_right)):
            if what:
                put(table.filter(table.column("__split")), what)
        both_a, both_b = ta.take(pa.array(found_a, pa.int64())), tb.take(pa.array(found_b, pa.int64()))
        for f in fields:
            va, vb = both_a.column(f), both_b.column(f)
            mask = pa.array(_differ(va, vb))
            put(both_a.filter(mask), f, va.filter(mask), vb.filter(mask))
        empty = pa.table({**{k: ta.schema.field(k).type and pa.array([], ta.schema.field(k).type) for k in keys}, **{x: pa.array([], pa.string()) for x in ("difference", "left_value", "right_value")}})
        return pa.concat_tables([empty, *parts]).combine_chunks()

    return a.groupBy("__bucket").cogroup(b.groupBy("__bucket")).applyInArrow(compare, schema)
