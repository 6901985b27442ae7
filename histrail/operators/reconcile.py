"""Comparing row counts of two sources, and streaks of clean comparisons."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Fixed values.
DUAL_RUN, RECONCILING, CLEAN_STREAK = "DUAL_RUN", "RECONCILING", "CLEAN_STREAK"
OLD_STATE_NAMES = {"N_GUN_TEMIZ": "CLEAN_STREAK", "CUTOVER_TALEP": "CUTOVER_REQUESTED", "CUTOVERLANMIS": "CUTOVER_APPLIED"}


def count_differences(here: DataFrame, there: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``keys, n_here, n_there, diff`` (absolute) from two frames of rows; a key on one side only counts 0 on the other."""
    a = here.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_here"))
    b = there.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_there"))
    j = a.join(b, list(keys), "full")
    n = [F.coalesce(c, F.lit(0)) for c in ("n_here", "n_there")]
    return j.select(*keys, n[0].alias("n_here"), n[1].alias("n_there"), F.abs(n[0] - n[1]).alias("diff"))


def clean_streaks(cycles: DataFrame, key: Sequence[str], order: str, *, target: int, epsilon: int) -> DataFrame:
    """Adds ``clean``, ``streak`` and ``state`` to comparisons (``diff``, ``critical``) in their order.

    A critical comparison is clean when nothing differs; another one when the difference is at most ``epsilon`` and no larger
    than the last (or there was none, or it was 0). The streak counts clean comparisons since the last that wasn't: gaps and
    islands by one window, valid while no command comes in between.
    """
    w = Window.partitionBy(*key).orderBy(order)
    last = F.coalesce(F.lag("diff").over(w), F.lit(0))
    clean = F.when(F.col("critical"), F.col("diff") == 0).otherwise((F.col("diff") <= epsilon) & ((F.col("diff") <= last) | (last == 0)))
    c = cycles.withColumn("clean", clean)
    island = F.sum(F.when(F.col("clean"), 0).otherwise(1)).over(w.rowsBetween(Window.unboundedPreceding, 0))
    c = c.withColumn("__island", island)
    streak = F.sum(F.col("clean").cast("int")).over(Window.partitionBy(*key, "__island").orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    c = c.withColumn("streak", streak).drop("__island")
    return c.withColumn("state", F.when(~F.col("clean"), DUAL_RUN).when(F.col("streak") >= target, CLEAN_STREAK).otherwise(RECONCILING))


def command_outcomes(commands: DataFrame, key: Sequence[str], order: str, *, target: int) -> DataFrame:
    """Every command with ``outcome`` (of requests only) and the ``state, streak, rollbacks`` after it.

    ``commands`` has ``command``: CLEAN and UNCLEAN comparisons; REQUEST, which holds only in a clean streak (else
    GATE_NOT_MET, nothing changes) and is REQUESTED, or APPLY_FAILED where ``failed`` is true (nothing changes); CONFIRM,
    unconditional; REVERT, back to the clean streak; ROLLBACK, to the start. Comparisons don't change what is cut over. Other
    commands do nothing. An ordered list a key is folded inside the engine: it is as long as a class has had nightly
    comparisons and commands, which time bounds and not the amount of data.
    """
    entry = F.struct(order, "command", (F.coalesce("failed", F.lit(False)) if "failed" in commands.columns else F.lit(False)).alias("failed"))
    log = commands.groupBy(*key).agg(F.array_sort(F.collect_list(entry)).alias("__log"))
    at = commands.schema[order].dataType.simpleString()
    row = f"struct<{order}:{at},command:string,outcome:string,state:string,streak:int,rollbacks:int>"
    start = F.struct(F.lit(DUAL_RUN).alias("state"), F.lit(0).alias("streak"), F.lit(0).alias("rollbacks"), F.array().cast(f"array<{row}>").alias("rows"))

    def step(a, x):
        c, s = F.coalesce(x["command"], F.lit("")), a["state"]
        applied = s == "CUTOVER_APPLIED"
        gate = s == CLEAN_STREAK
        outcome = F.when(c == "REQUEST", F.when(~gate, "GATE_NOT_MET").when(x["failed"], "APPLY_FAILED").otherwise("REQUESTED"))
        streak = F.when((c == "CLEAN") & ~applied, a["streak"] + 1).when((c == "UNCLEAN") & ~applied | (c == "ROLLBACK"), F.lit(0)).otherwise(a["streak"])
        state = (
            F.when(applied & c.isin("CLEAN", "UNCLEAN"), s).when(c == "CLEAN", F.when(streak >= target, F.lit(CLEAN_STREAK)).otherwise(F.lit(RECONCILING))).when(c.isin("UNCLEAN", "ROLLBACK"), F.lit(DUAL_RUN))
            .when((c == "REQUEST") & gate & ~x["failed"], F.lit("CUTOVER_REQUESTED")).when(c == "CONFIRM", F.lit("CUTOVER_APPLIED")).when(c == "REVERT", F.lit(CLEAN_STREAK)).otherwise(s)
        )
        rollbacks = a["rollbacks"] + (c == "ROLLBACK").cast("int")
        new = F.struct(x[order].alias(order), x["command"].alias("command"), outcome.alias("outcome"), state.alias("state"), streak.alias("streak"), rollbacks.alias("rollbacks"))
        return F.struct(state.alias("state"), streak.alias("streak"), rollbacks.alias("rollbacks"), F.concat(a["rows"], F.array(new.cast(row))).alias("rows"))

    return log.select(*key, F.explode(F.aggregate("__log", start, step, lambda a: a["rows"])).alias("__r")).select(*key, "__r.*")


def fold_commands(commands: DataFrame, key: Sequence[str], order: str, *, target: int) -> DataFrame:
    """The final ``state, streak, rollbacks`` of each key, see :func:`command_outcomes`."""
    last = F.max_by(F.struct("state", "streak", "rollbacks"), order)
    return command_outcomes(commands, key, order, target=target).groupBy(*key).agg(last.alias("__r")).select(*key, "__r.*")


def renamed_states(df: DataFrame, column: str = "state") -> DataFrame:
    """Old state names as the present ones; others stay."""
    c = F.col(column)
    out = F.coalesce(*[F.when(c == old, F.lit(new)) for old, new in OLD_STATE_NAMES.items()], c)
    return df.withColumn(column, out)


# The order in which classes are cut over, by volume.
CUTOVER_ORDER = ("DETAIL", "VARINST", "ACTINST", "JOB_LOG", "TASKINST", "PROCINST", "COMMENT", "ATTACHMENT", "IDENTITYLINK", "DECINST", "CASEINST", "BATCH", "EXT_TASK_LOG", "INCIDENT", "OP_LOG")


def cutover_order(classes: DataFrame, keys: Sequence[str], order: Sequence[str] = CUTOVER_ORDER) -> DataFrame:
    """Adds ``place`` (from 1) to the classes of each key; unlisted and null ones come last. A key has as many rows as classes."""
    at = F.coalesce(*[F.when(F.col("history_class") == c, F.lit(i)) for i, c in enumerate(order)])
    return classes.withColumn("place", F.row_number().over(Window.partitionBy(*keys).orderBy(F.asc_nulls_last(at), "history_class")))
