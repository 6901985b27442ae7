"""Retention, erasure and pseudonymisation."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalar as S
from ..schemas import AUDIT_CRITICAL, CLASSES, ERASED_COLUMNS

# Days that audit-critical classes are kept by default, those of the others, and the gap that parts two cases.
CRITICAL_DAYS, BULK_DAYS, GAP_DAYS = 7 * 365, 90, 90


@dataclass
class RetentionRules:
    overrides: dict[str, int] = field(default_factory=dict)
    minimum_critical_days: int = CRITICAL_DAYS

    def days(self, history_class: str) -> int:
        return self.overrides.get(history_class, CRITICAL_DAYS if history_class in AUDIT_CRITICAL else BULK_DAYS)

    def check(self) -> None:
        """An audit-critical class may not be kept for less than the minimum."""
        low = [c for c, d in self.overrides.items() if c in AUDIT_CRITICAL and d < self.minimum_critical_days]
        if low:
            raise ValueError(f"kept for less than the minimum: {low}")


def partitions(rows: DataFrame, anchor: str, history_class: str) -> DataFrame:
    """``history_class, month, upper_bound, n_rows`` of each monthly partition of a table; rows without an anchor are in none."""
    month = F.trunc(F.col(anchor).cast("date"), "MM")
    counted = rows.filter(F.col(anchor).isNotNull()).groupBy(month.alias("__m")).agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.select(F.lit(history_class).alias("history_class"), F.date_format("__m", "yyyy-MM").alias("month"), F.add_months("__m", 1).cast("timestamp").alias("upper_bound"), "n_rows")


def due(parts: DataFrame, as_of: datetime | Column, rules: RetentionRules) -> DataFrame:
    """Partitions whose upper bound lies before ``as_of`` minus the class's window, strictly; with what goes into the audit."""
    days = F.coalesce(*[F.when(F.col("history_class") == c, F.lit(rules.days(c))) for c in CLASSES])
    now = F.lit(as_of).cast("timestamp") if not isinstance(as_of, Column) else as_of
    cut = F.timestamp_micros(F.unix_micros(now) - days.cast("long") * 86_400_000_000)
    basis = F.when(F.col("history_class").isin(*AUDIT_CRITICAL), F.lit("LEGAL_MINIMUM"))
    return parts.withColumn("window_days", days).filter(F.col("upper_bound") < cut).withColumns({"action": F.lit("DROP_PARTITION"), "legal_basis": basis})


def surviving(rows: DataFrame, anchor: str, drop: DataFrame) -> DataFrame:
    """Rows outside the dropped months. Months are few, so they go with the plan."""
    gone = drop.select(F.col("month").alias("__month"))
    return rows.withColumn("__month", F.date_format(anchor, "yyyy-MM")).join(F.broadcast(gone), "__month", "left_anti").drop("__month")


def case_groups(instances: DataFrame, subject: str, start: str, tie: str, gap_days: int = GAP_DAYS) -> DataFrame:
    """Adds ``case_group`` (from 0) to the instances of each subject: a start more than the gap after the last known start
    before it begins a new group; an instance without a start joins the group before it."""
    w = Window.partitionBy(subject).orderBy(F.asc_nulls_last(start), tie)
    before = F.last(start, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    apart = F.unix_micros(start) - F.unix_micros(before) > gap_days * 86_400_000_000
    flagged = instances.withColumn("__new", F.coalesce(apart, F.lit(False)).cast("int"))
    return flagged.withColumn("case_group", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("__new")


def scope_outcome(groups: DataFrame, subject: str) -> DataFrame:
    """For each subject: its instances and groups, and whether the scope must be confirmed (more than one group)."""
    got = groups.groupBy(subject).agg(F.count(F.lit(1)).alias("n_instances"), (F.max("case_group") + 1).alias("n_groups"))
    return got.withColumn("outcome", F.when(F.col("n_groups") > 1, "CONFIRMATION_REQUIRED").otherwise("RESOLVED"))


def erasable(classes: list[str]) -> tuple[list[str], str]:
    """The classes of a request without the audit-critical ones, and the outcome if none is left."""
    rest = [c for c in classes if c not in AUDIT_CRITICAL]
    return rest, "ACCEPTED" if rest else "LEGAL_HOLD_BLOCKED"


def request_outcomes(requests: DataFrame, scopes: DataFrame, subject: str) -> DataFrame:
    """Requests (``subject``, ``classes``) with the classes that may be erased and the outcome: LEGAL_HOLD_BLOCKED if none is
    left, CONFIRMATION_REQUIRED if the subject's instances are of more than one case, else ACCEPTED. ``scopes`` is the result
    of :func:`scope_outcome`; a subject without instances is accepted, there is nothing to erase."""
    asked = requests.withColumn("erasable", F.array_except(F.coalesce("classes", F.array().cast("array<string>")), F.array(*[F.lit(c) for c in AUDIT_CRITICAL])))
    joined = asked.join(scopes.select(subject, F.col("outcome").alias("__scope")), subject, "left")
    outcome = F.when(F.size("erasable") == 0, "LEGAL_HOLD_BLOCKED").when(F.col("__scope") == "CONFIRMATION_REQUIRED", "CONFIRMATION_REQUIRED").otherwise("ACCEPTED")
    return joined.withColumn("outcome", outcome).drop("__scope")


def pending_scopes(groups: DataFrame, subject: str, requests: DataFrame) -> DataFrame:
    """What has to be confirmed, one row a candidate instance: ``request_id, subject, process_instance_id, status``.
    ``requests`` has the subject and ``request_id``. Rows, and not one document a request, for a subject may have any number."""
    return groups.join(requests.select(subject, "request_id"), subject).select("request_id", subject, "process_instance_id", F.lit("PENDING").alias("status"))


def confirm_scopes(pending: DataFrame, confirmed: DataFrame) -> DataFrame:
    """The candidates after an answer (``request_id, process_instance_id``): those named are CONFIRMED, the others of an answered
    request REJECTED, those of other requests stay PENDING. What is named but was no candidate is left out."""
    named = confirmed.select(F.col("request_id").alias("__n"), F.col("process_instance_id").alias("__i")).distinct()
    answered = confirmed.select(F.col("request_id").alias("__r")).distinct()
    j = pending.join(named, (F.col("request_id") == F.col("__n")) & (F.col("process_instance_id") == F.col("__i")), "left")
    j = j.join(answered, F.col("request_id") == F.col("__r"), "left")
    open_ = F.col("status") == "PENDING"
    return j.withColumn("status", F.when(open_ & F.col("__i").isNotNull(), "CONFIRMED").when(open_ & F.col("__r").isNotNull(), "REJECTED").otherwise(F.col("status"))).drop("__n", "__i", "__r")


def release_deltas(rows: DataFrame, reference: str, among: DataFrame, keys: list[str]) -> DataFrame:
    """``payload_id, delta``: one reference less for each row that goes (its ``keys`` are in ``among``) and holds one; summed by
    payload, with a map-side part."""
    gone = rows.filter(F.col(reference).isNotNull()).join(among.select(*keys).distinct(), keys, "left_semi")
    return gone.groupBy(F.col(reference).alias("payload_id")).agg((-F.count(F.lit(1))).alias("delta"))


def after_release(payloads: DataFrame, deltas: DataFrame) -> DataFrame:
    """``id, ref_count`` of the payloads that are left: counts don't fall below zero, and a payload that nobody refers to any
    more goes with its last reference. Payloads that no delta names stay as they are; deltas of unknown payloads do nothing."""
    d = deltas.groupBy("payload_id").agg(F.sum("delta").alias("__d"))
    j = payloads.select("id", "ref_count").join(d, F.col("id") == F.col("payload_id"), "left")
    left = F.greatest(F.lit(0), F.coalesce("ref_count", F.lit(0)) + F.coalesce("__d", F.lit(0))).cast("long")
    return j.withColumn("ref_count", F.when(F.col("__d").isNull(), F.col("ref_count").cast("long")).otherwise(left)).filter(F.col("__d").isNull() | (F.col("ref_count") > 0)).select("id", "ref_count")


def anonymise(rows: DataFrame, history_class: str, scope: DataFrame, at: datetime | Column) -> DataFrame:
    """Rows of a class after the erasure of ``scope`` (process_instance_id): those in scope and not deleted yet lose their
    personal columns and are marked; ``affected`` flags them. Classes without an instance are matched by no scope."""
    if not CLASSES[history_class].own_instance:
        return rows.withColumn("affected", F.lit(False))
    now = F.lit(at).cast("timestamp") if not isinstance(at, Column) else at
    hit = scope.select(F.col("process_instance_id").alias("__id"), F.lit(True).alias("__hit")).distinct()
    joined = rows.join(hit, F.col("process_instance_id") == F.col("__id"), "left")
    affected = F.col("__hit").isNotNull() & F.col("deleted_at").isNull()
    flagged = joined.withColumn("affected", affected)
    names = ERASED_COLUMNS.get(history_class, ())
    columns = {c: F.when(~F.col("affected"), F.col(c)) for c in names if c in rows.columns}
    columns |= {c: F.when(F.col("affected"), now).otherwise(F.col(c)) for c in ("deleted_at", "anonymized_at") if c in rows.columns}
    return flagged.withColumns(columns).drop("__id", "__hit")


def leftovers(rows: DataFrame, history_class: str, scope: DataFrame) -> DataFrame:
    """Rows of the scope, deleted ones included, that still hold a personal column: none after a complete erasure."""
    names = [c for c in ERASED_COLUMNS.get(history_class, ()) if c in rows.columns]
    held = rows.filter(S.any_of([F.col(c).isNotNull() for c in names]))
    return held.join(scope.select("process_instance_id").distinct(), "process_instance_id", "left_semi")


def erasure_audit(results: dict[str, DataFrame], request_id: str, subject_key: str) -> DataFrame:
    """One audit row a table: how many rows the request touched."""
    parts = [df.agg(F.count_if("affected").alias("affected_row_count")).select(F.lit(request_id).alias("request_id"), F.lit(subject_key).alias("subject_key"), F.lit(CLASSES[c].table).alias("target_table"), F.lit("ANONYMIZE").alias("action"), "affected_row_count") for c, df in results.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def verified_audit(audit: DataFrame, leftovers_of: dict[str, DataFrame]) -> DataFrame:
    """The audit with ``verification_status``: by table FAILED if personal columns are left in its scope, else PASSED; PENDING
    for tables that weren't looked at."""
    states = [df.agg(F.count(F.lit(1)).alias("__n")).select(F.lit(CLASSES[c].table).alias("__t"), F.when(F.col("__n") > 0, "FAILED").otherwise("PASSED").alias("__s")) for c, df in leftovers_of.items()]
    if not states:
        return audit.withColumn("verification_status", F.lit("PENDING"))
    every = states[0]
    for x in states[1:]:
        every = every.unionByName(x)
    # one row a table
    return audit.join(F.broadcast(every), F.col("target_table") == F.col("__t"), "left").withColumn("verification_status", F.coalesce("__s", F.lit("PENDING"))).drop("__t", "__s")


def pseudonymise(fields: DataFrame, history_class: Column, map_column: str, tenant_key: str, version: int) -> DataFrame:
    """Operation-log bodies with a non-blank user: the user goes, a token and a flag come."""
    m = F.col(map_column)
    user = F.try_element_at(m, F.lit("userId"))
    applies = (history_class == "OP_LOG") & ~S.blank(user)
    token = S.hmac_sha256_hex(user, f"{tenant_key}:{version}")
    changed = F.map_concat(F.map_filter(m, lambda k, _: k != "userId"), F.create_map(F.lit("userIdPseudonymized"), F.lit("true"), F.lit("pseudonymToken"), token))
    return fields.withColumn(map_column, F.when(applies, changed).otherwise(m))


class Vault:
    """Tokens and the encrypted users behind them. Every access, granted or not, gives an audit row."""

    def __init__(self, secret: str):
        if len(secret) not in (16, 24, 32):
            raise ValueError("the secret must have 16, 24 or 32 characters")
        self.secret = secret

    def entries(self, users: DataFrame, user: str, tenant_key: str, version: int, seen: str) -> DataFrame:
        """``pseudonym_token, tenant_key_version, real_user_id_encrypted, first_seen_at``: one row a user."""
        one = users.filter(~S.blank(F.col(user))).groupBy(user).agg(F.min(seen).alias("first_seen_at"))
        return one.select(S.hmac_sha256_hex(F.col(user), f"{tenant_key}:{version}").alias("pseudonym_token"), F.lit(version).alias("tenant_key_version"), F.aes_encrypt(F.col(user), F.lit(self.secret)).alias("real_user_id_encrypted"), "first_seen_at")

    def store(self, known: DataFrame, new: DataFrame) -> DataFrame:
        """Known entries stay; new tokens are added."""
        return known.unionByName(new.join(known.select("pseudonym_token"), "pseudonym_token", "left_anti"))

    def delete(self, entries: DataFrame, requests: DataFrame) -> tuple[DataFrame, DataFrame]:
        """The entries without those whose deletion was granted, and the audit rows of all requests (columns as for
        :meth:`reidentify`); a request for an unknown token changes nothing and is audited."""
        audit = requests.select("pseudonym_token", F.lit("DELETE").alias("operation"), "accessor_identity", "access_reason", "granted")
        return entries.join(requests.filter("granted").select("pseudonym_token").distinct(), "pseudonym_token", "left_anti"), audit

    def reidentify(self, entries: DataFrame, requests: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Answers to ``requests`` (pseudonym_token, accessor_identity, access_reason, granted) and the audit rows of all of them."""
        audit = requests.select("pseudonym_token", F.lit("REIDENTIFY").alias("operation"), "accessor_identity", "access_reason", "granted")
        answers = requests.filter("granted").join(entries, "pseudonym_token").select("pseudonym_token", F.try_aes_decrypt("real_user_id_encrypted", F.lit(self.secret)).cast("string").alias("user_id"))
        return answers, audit
