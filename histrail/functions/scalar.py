"""Column functions. All are expressions of the engine's own functions, so they stay inside generated code."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
MARKER_PREFIX = "NATSEXT1:"
DEFAULT_THRESHOLD = 4096
MASK = "***"
REPLY_TYPES = ("SUCCESS", "BPMN_ERROR", "TRANSIENT")
RESERVED_PREFIXES = ("jobs.", "dlq.events.", "events.")
MESSAGE_TYPE = "^[A-Za-z0-9_-]+$"


def blank(c: Column) -> Column:
    return c.isNull() | (F.trim(c) == "")


def sha256_hex(c: Column) -> Column:
    return F.sha2(c, 256)


def is_sha256_hex(c: Column) -> Column:
    return F.coalesce(c.rlike("^[0-9a-f]{64}$"), F.lit(False))


def marker_of(content_hash: Column) -> Column:
    """The text that takes the place of a value stored elsewhere."""
    return F.concat(F.lit(MARKER_PREFIX), content_hash)


def hash_in_marker(value: Column) -> Column:
    """The hash of a marker, null for any other text."""
    n = len(MARKER_PREFIX)
    rest = F.substring(value, n + 1, 64)
    return F.when((F.length(value) == n + 64) & value.startswith(MARKER_PREFIX) & is_sha256_hex(rest), rest)


def too_large(value: Column, threshold: int = DEFAULT_THRESHOLD) -> Column:
    """Strictly more bytes than the threshold."""
    return F.coalesce(F.octet_length(value) > threshold, F.lit(False))


def _pads(key: bytes) -> tuple[str, str]:
    if len(key) > 64:
        key = hashlib.sha256(key).digest()
    key = key.ljust(64, b"\0")
    return bytes(b ^ 0x36 for b in key).hex(), bytes(b ^ 0x5C for b in key).hex()


def hmac_sha256_hex(message: Column, key: str) -> Column:
    """HMAC as two nested hashes over pads worked out on the driver."""
    inner, outer = _pads(key.encode())
    first = F.sha2(F.concat(F.unhex(F.lit(inner)), F.encode(message, "UTF-8")), 256)
    return F.sha2(F.concat(F.unhex(F.lit(outer)), F.unhex(first)), 256)


def pseudonym_token(user: Column, tenant_key: str, version: int) -> Column:
    """The token of a user under one version of a tenant's key. Null and empty users are errors, as is an empty key."""
    if not tenant_key:
        raise ValueError("a tenant key is needed")
    checked = F.when(user.isNull() | (user == ""), F.raise_error(F.lit("a user id is needed"))).otherwise(user)
    return hmac_sha256_hex(checked, f"{tenant_key}:{version}")


def backoff_seconds(delivery: Column, most: int = 30) -> Column:
    return F.least(F.lit(most), F.pow(F.lit(2), F.greatest(F.lit(0), delivery - 1))).cast("long")


def lock_floor_seconds(max_attempts: int, wait: int, sweep: int, slack: int) -> int:
    """How long a lock must last: all attempts, the backoff between them, a sweep and some slack."""
    return max_attempts * wait + sum(min(30, 2 ** (n - 1)) for n in range(1, max_attempts)) + sweep + slack


def lock_floor(max_attempts: Column, wait: Column, sweep: Column, slack: Column) -> Column:
    """The same as a column."""
    steps = F.when(max_attempts > 1, F.sequence(F.lit(1), max_attempts - 1)).otherwise(F.array().cast("array<int>"))
    back = F.aggregate(steps, F.lit(0).cast("long"), lambda a, n: a + F.least(F.lit(30), F.pow(F.lit(2), n - 1)).cast("long"))
    return max_attempts * wait + back + sweep + slack


def history_subject(engine: Column, history_class: Column, instance: Column) -> Column:
    return F.concat_ws(".", F.lit("history"), engine, history_class, instance)


def outbound_subject(engine: Column, message_type: Column, instance: Column) -> Column:
    """Null where a part is blank or the type has other characters than letters, digits, ``_`` and ``-``."""
    fine = ~blank(engine) & ~blank(instance) & F.coalesce(message_type.rlike(MESSAGE_TYPE), F.lit(False))
    return F.when(fine, F.concat_ws(".", F.lit("events"), engine, message_type, instance))


def dlq_subject(subject: Column) -> Column:
    return F.concat(F.lit("dlq."), subject)


def class_of_subject(subject: Column) -> Column:
    """The third part of a subject."""
    return F.coalesce(F.try_element_at(F.split(subject, r"\."), F.lit(3)), F.lit("UNKNOWN"))


def reserved_namespace(subject: Column) -> Column:
    """The reserved prefix of a subject; ``dlq.events.`` before ``events.``."""
    return F.coalesce(*[F.when(subject.startswith(p), F.lit(p)) for p in RESERVED_PREFIXES])


def message_id(event_id: Column, event_type: Column) -> Column:
    return F.concat(event_id, F.lit(":"), event_type)


def without_dlq_suffix(c: Column) -> Column:
    return F.regexp_replace(c, r"\.dlq$", "")


def first_text_after(body: Column, field: str) -> Column:
    """The first quoted text after the first mention of a field, wherever that is: a scan, not a parse. It may find a
    nested key, or skip a number; :func:`json_text` doesn't."""
    name = re.escape(field)
    found = F.regexp_extract(body, rf'(?s)"{name}"[^:]*:[^"]*"([^"]*)"', 1)
    return F.when(F.coalesce(body.rlike(rf'(?s)"{name}"[^:]*:[^"]*"[^"]*"'), F.lit(False)), found)


def json_text(body: Column, field: str) -> Column:
    return F.get_json_object(body, f"$.{field}")


def clean_headers(headers: Column) -> Column:
    """Headers without null values; a null map stays null."""
    return F.map_filter(headers, lambda _, v: v.isNotNull())


def header(headers: Column, name: str, *older: str) -> Column:
    """A header, or an older name of it; blank values count as none."""
    return F.coalesce(*[F.when(~blank(F.try_element_at(headers, F.lit(n))), F.try_element_at(headers, F.lit(n))) for n in (name, *older)])


def business_key(headers: Column, header_name: str | None, variables: Column, variable_name: str | None) -> Column:
    """From the header if one is configured, and only from there; else from the variable; else null."""
    if header_name:
        return F.try_element_at(headers, F.lit(header_name))
    return F.try_element_at(variables, F.lit(variable_name)) if variable_name else F.lit(None).cast("string")


def reply_type(body: Column) -> Column:
    """The type of a reply: top level only, case-sensitive after trimming; null if missing, unknown or the body is no JSON."""
    t = F.trim(F.get_json_object(body, "$.type"))
    return F.when(t.isin(*REPLY_TYPES), t)


def reply_retries(body: Column) -> Column:
    return F.coalesce(F.get_json_object(body, "$.retries").try_cast("int"), F.lit(0))


def captured(variables: Column, allowed: Sequence[str]) -> Column:
    """The allowed variables that are present, in the order of the list."""
    pairs = [F.when(F.map_contains_key(variables, n), F.struct(F.lit(n).alias("key"), F.try_element_at(variables, F.lit(n)).alias("value"))) for n in allowed]
    return F.map_from_entries(F.filter(F.array(*pairs), lambda x: x.isNotNull()))


def masked(c: Column, permitted: bool) -> Column:
    """Without permission every value, null too, reads the same."""
    return c if permitted else F.lit(MASK)


def json_of(fields: Mapping[str, Column], keep_null: bool) -> Column:
    """A JSON object; numbers and booleans stand as they are."""
    return F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()]), {"ignoreNullFields": str(not keep_null).lower()})


def period_days(period: Column) -> Column:
    """Days of an ISO period: years of 365, months of 30. Null if it is none."""
    part = lambda unit: F.coalesce(F.nullif(F.regexp_extract(period, rf"(-?\d+){unit}", 1), F.lit("")).cast("long"), F.lit(0))
    fine = period.rlike(r"^P(?=\d|-)(-?\d+Y)?(-?\d+M)?(-?\d+W)?(-?\d+D)?$")
    return F.when(fine, part("Y") * 365 + part("M") * 30 + part("W") * 7 + part("D"))


def bound_in(text: Column) -> Column:
    """The upper bound in the text of a range partition, null if there is none to read."""
    found = F.regexp_extract(text, r"TO \('([^']+)'\)", 1)
    return F.try_to_timestamp(F.when(found != "", found), F.lit("yyyy-MM-dd HH:mm:ssx"))


def any_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))
