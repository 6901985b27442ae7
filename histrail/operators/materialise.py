"""From routed events to history tables: latest-by-sequence merge and keyed append."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import CLASSES, COLUMN_DEFAULTS, wire_keys_for
from .changes import Kind
from .ordered import max_before, numbered


def typed(column: Column, kind: str) -> Column:
    """A body's text as a column's type; times are epoch milliseconds. Null where it can't be read."""
    if kind == "timestamp":
        return F.timestamp_millis(column.try_cast("bigint"))
    return column if kind == "string" else column.try_cast(kind)


def outcomes(events: DataFrame, key: Sequence[str], sequence: str, arrival: str) -> DataFrame:
    """Adds ``outcome``: APPLIED when the sequence is above all that arrived before for the key, else STALE_DISCARDED."""
    before = F.col("__before")
    known = max_before(events, key, [arrival], sequence, "__before")
    return known.withColumn("outcome", F.when(before.isNull() | (F.col(sequence) > before), "APPLIED").otherwise("STALE_DISCARDED")).drop("__before")


def merge_entities(events: DataFrame, key: Sequence[str], columns: Sequence[tuple[str, str]], keys_of: dict[str, list[str]] | None = None, *, sequence: str = "stream_sequence", arrival: str = "arrival_no", time: str = "event_time", fields: str = "fields") -> DataFrame:
    """One row a key: the last value of each column, the highest sequence, and the anchor (the time of the first arrival).

    A column takes the value of the event with the highest sequence whose body has its key: an absent key keeps the old
    value, an explicit null overwrites it. As a discarded event is below one that arrived before it, it can't hold the
    highest sequence of a key it shares with that one, but it can be the only one to have a key; so discarded events are left
    out first, by one window over the key. The anchor is the first event to arrive, which always applies.
    """
    applied = outcomes(events, key, sequence, arrival).filter(F.col("outcome") == "APPLIED")
    aggregates = []
    for name, kind in columns:
        wires = (keys_of or {}).get(name, [name])
        has = F.coalesce(*[F.when(F.map_contains_key(fields, w), F.lit(w)) for w in wires])
        value = F.try_element_at(fields, has)
        latest = F.max_by(F.struct(value.alias("v")), F.when(has.isNotNull(), F.col(sequence)))
        out = typed(latest["v"], kind)
        if name in COLUMN_DEFAULTS:
            # the default stands only where no applied event had the key
            out = F.when(F.max(F.when(has.isNotNull(), 1)).isNull(), F.lit(COLUMN_DEFAULTS[name])).otherwise(out)
        aggregates.append(out.alias(name))
    return applied.groupBy(*key).agg(*aggregates, F.max(sequence).alias("stream_sequence"), F.max_by(time, sequence).alias("event_time"), F.min_by(time, arrival).alias("partition_anchor_at"), F.count(F.lit(1)).alias("n_applied"))


def merge_class(events: DataFrame, history_class: str) -> DataFrame:
    """Merge parsed events of one entity class into its table's columns. The entity key is read from the body, or from the
    envelope where it is the process instance."""
    c = CLASSES[history_class]
    if c.key == "process_instance_id":
        keyed = events
    else:
        keyed = events.withColumn(c.key, F.coalesce(*[F.try_element_at("fields", F.lit(w)) for w in wire_keys_for(history_class, c.key)]))
    columns = [x for x in c.columns if x[0] != c.key]
    return merge_entities(keyed, ["engine_id", c.key], columns, {n: wire_keys_for(history_class, n) for n, _ in columns})


_ENTITY = "engine_id string, entity_key string, values map<string,string>, stream_sequence long, event_time timestamp, anchor_at timestamp, arrival_no long, n_applied long"


def entity_kind(history_class: str) -> Kind:
    """Stored current rows of an entity class, as a kind of bucketed table: a change set is merged into the touched buckets, and
    an event is applied only if its sequence is above that of its row (compare and set). The rows are as :func:`merge_class`
    would make them of all events in the order of the sets. ``values`` holds the texts of the columns that any applied event
    had, explicit nulls included."""
    c = CLASSES[history_class]
    columns = [(n, wire_keys_for(history_class, n)) for n, _ in c.columns if n != c.key]

    def rows(events: DataFrame) -> DataFrame:
        key = F.col(c.key) if c.key == "process_instance_id" else F.coalesce(*[F.try_element_at("fields", F.lit(w)) for w in wire_keys_for(history_class, c.key)])
        entries = []
        for name, wires in columns:
            has = F.coalesce(*[F.when(F.map_contains_key("fields", w), F.lit(w)) for w in wires])
            entries.append(F.when(has.isNotNull(), F.struct(F.lit(name).alias("key"), F.try_element_at("fields", has).alias("value"))))
        return events.select("engine_id", key.alias("entity_key"), F.map_from_entries(F.array_compact(F.array(*entries))).alias("values"), "stream_sequence", "event_time", F.col("event_time").alias("anchor_at"), "arrival_no", F.lit(1).cast("long").alias("n_applied"))

    def merge(base: DataFrame | None, new: DataFrame) -> DataFrame:
        every = new.withColumn("__new", F.lit(1))
        if base is not None:
            every = base.withColumn("__new", F.lit(0)).unionByName(every)
        key = ["__bucket", "engine_id", "entity_key"]
        applied = max_before(every, key, ["__new", "arrival_no"], "stream_sequence", "__before").filter(F.col("__before").isNull() | (F.col("stream_sequence") > F.col("__before")))
        has = {n: F.map_contains_key("values", n) for n, _ in columns}
        last = [F.max_by(F.struct(F.try_element_at("values", F.lit(n)).alias("v")), F.when(h, F.col("stream_sequence"))).alias(f"__v_{n}") for n, h in has.items()]
        there = [F.max(h).alias(f"__h_{n}") for n, h in has.items()]
        got = applied.groupBy(*key).agg(*last, *there, F.max("stream_sequence").alias("stream_sequence"), F.max_by("event_time", "stream_sequence").alias("event_time"), F.min_by("anchor_at", F.struct("__new", "arrival_no")).alias("anchor_at"), F.sum("n_applied").alias("n_applied"))
        entries = [F.when(F.col(f"__h_{n}"), F.struct(F.lit(n).alias("key"), F.col(f"__v_{n}.v").alias("value"))) for n, _ in columns]
        return got.select(*key, F.map_from_entries(F.array_compact(F.array(*entries))).alias("values"), "stream_sequence", "event_time", "anchor_at", F.lit(0).cast("long").alias("arrival_no"), "n_applied")

    return Kind(("engine_id", "entity_key"), _ENTITY, rows, merge)


def entity_rows(stored: DataFrame, history_class: str) -> DataFrame:
    """The class's columns from its stored rows, in the form of :func:`merge_class`."""
    c = CLASSES[history_class]
    out = []
    for name, kind in c.columns:
        if name == c.key:
            continue
        value = typed(F.try_element_at("values", F.lit(name)), kind)
        out.append((F.when(~F.map_contains_key("values", name), F.lit(COLUMN_DEFAULTS[name])).otherwise(value) if name in COLUMN_DEFAULTS else value).alias(name))
    return stored.select("engine_id", F.col("entity_key").alias(c.key), *out, "stream_sequence", "event_time", F.col("anchor_at").alias("partition_anchor_at"), "n_applied")


def append_log(events: DataFrame, key: Sequence[str] = ("engine_id", "history_event_id", "event_type", "event_time"), arrival: str = "arrival_no") -> DataFrame:
    """Adds ``outcome``: the first event of a key to arrive is APPLIED, the others DEDUP_SKIPPED."""
    return numbered(events, key, [arrival], "__nth").withColumn("outcome", F.when(F.col("__nth") == 1, "APPLIED").otherwise("DEDUP_SKIPPED")).drop("__nth")


def first_of(events: DataFrame, key: Sequence[str], arrival: str) -> DataFrame:
    """The first row of each key by arrival, by an aggregate with a map-side part: a hot key costs one row a task."""
    rest = [c for c in events.columns if c not in key and c != arrival]
    best = F.min(F.struct(arrival, *rest)).alias("__b") if not _has_map(events) else F.min_by(F.struct(arrival, *rest), F.col(arrival)).alias("__b")
    return events.groupBy(*key).agg(best).select(*key, "__b.*")


def _has_map(df: DataFrame) -> bool:
    return any(isinstance(f.dataType, (T.MapType, T.VariantType)) for f in df.schema.fields)


def log_rows(events: DataFrame, history_class: str) -> DataFrame:
    """The columns of a log class from parsed events."""
    c = CLASSES[history_class]
    values = []
    for name, kind in c.columns:
        has = F.coalesce(*[F.when(F.map_contains_key("fields", w), F.lit(w)) for w in wire_keys_for(history_class, name)])
        v = typed(F.try_element_at("fields", has), kind)
        if name in COLUMN_DEFAULTS:
            v = F.when(has.isNull(), F.lit(COLUMN_DEFAULTS[name])).otherwise(v)
        values.append(v.alias(name))
    return events.select("engine_id", "process_instance_id", "history_event_id", "event_type", *values, F.col("seq").alias("stream_sequence"), "event_time", F.lit(c.critical).alias("legal_hold"))


def month_of(c: Column) -> Column:
    """The partition of a row."""
    return F.date_format(c, "yyyy-MM")


def all_classes(tables: dict[str, DataFrame], columns: Sequence[str]) -> DataFrame:
    """One view over the tables of several classes, with ``history_class``."""
    parts = [df.select(F.lit(name).alias("history_class"), *columns) for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
