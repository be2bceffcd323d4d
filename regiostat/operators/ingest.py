"""Ingestion control as set operations (O-11..O-18).

The reference walks a nested year x month x region loop, asks the database
per slot whether it was collected, and keeps failures in a Python list.
Here the slot grid is a generated DataFrame, "already collected" is an anti
join, typing is column expressions, slot atomicity is an aggregate, and
failures are rows of a dead-letter table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiostat.functions.scalars import code_prefix, lenient_double, lenient_int
from regiostat.operators.joins import anti_join, broadcast_if_small

# ---------------------------------------------------------------------------
# The 17 province request codes and the collection bounds of the
# reference (first and last month collected).
REGION_CODES = [
    "1100000000", "2600000000", "2700000000", "2800000000", "2900000000", "3000000000",
    "3100000000", "3600000000", "4100000000", "4300000000", "4400000000", "4600000000",
    "4700000000", "4800000000", "5000000000", "5100000000", "5200000000",
]
FIRST_MONTH = "2013-05"
LAST_MONTH = "2025-11"
MAX_ATTEMPTS = 10
# ---------------------------------------------------------------------------


def month_sequence(start: str, end: str) -> Column:
    """Array of first-of-month dates ``start..end`` ('YYYY-MM' bounds)."""
    return F.sequence(F.to_date(F.lit(start + "-01")), F.to_date(F.lit(end + "-01")),
                      F.expr("interval 1 month"))


def slot_grid(regions: DataFrame, region_col: str, start: str, end: str,
              prefix_len: int | None = 2) -> DataFrame:
    """(year, month, region code) work list (O-11, O-16, O-37).

    Generated per region row with ``explode(sequence(...))`` (bounded by the
    number of months); the region code is cut to its first ``prefix_len``
    characters like ``r[:2]``.
    """
    code = code_prefix(region_col, prefix_len) if prefix_len else F.col(region_col)
    return (regions.select(code.alias("sd_code"), F.explode(month_sequence(start, end)).alias("_m"))
                   .select(F.year("_m").alias("year"), F.month("_m").alias("month"),
                           F.col("sd_code").cast("int").alias("sd_code")))


def pending_slots(slots: DataFrame, collected: DataFrame,
                  keys: Sequence[str] = ("year", "month", "sd_code")) -> DataFrame:
    """Slots with no stored row yet (O-36, O-05): any row marks a slot done."""
    return anti_join(slots, collected, list(keys))


def convert_payload(rows: DataFrame) -> DataFrame:
    """``convert_input`` as expressions (O-12, O-15): request code attached as
    ``sd_code``; names mapped; every numeric parsed leniently so a bad value
    becomes NULL and is flagged instead of aborting the job.

    ``_bad`` is true when any field the reference parses with ``int()``/
    ``float()`` is missing or malformed.
    """
    typed = rows.select(
        lenient_int("metroCd").cast("int").alias("sd_code"),
        lenient_int("year").cast("int").alias("year"),
        lenient_int("month").cast("int").alias("month"),
        F.col("metro").alias("sd_name"),
        F.col("city").alias("sgg_name"),
        lenient_int("houseCnt").alias("house_cnt"),
        lenient_double("powerUsage").alias("power_usage"),
        lenient_int("bill").alias("bill"),
        F.col("req_year"), F.col("req_month"),
        *[F.col(c) for c in ("response", "unreadable") if c in rows.columns])
    required = ["sd_code", "year", "month", "house_cnt", "power_usage", "bill"]
    bad = F.lit(False)
    for c in required:
        bad = bad | F.col(c).isNull()
    return typed.withColumn("_bad", bad)


def split_by_slot(typed: DataFrame, slot_keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """All-or-nothing per slot (O-13, O-14): one bad row rejects its whole slot.

    Bad slots are found with an aggregate (partial, so a hot slot is combined
    map side); the good rows are those whose slot is not among them.  Returns
    (good rows, dead-letter rows with a reason).
    """
    # keys are compared null-safely: a slot whose key could not be read is bad
    # as a whole and must match itself
    bad_slots = typed.where(F.col("_bad")).select(*[F.col(k).alias(f"_slot_{k}") for k in slot_keys]).distinct()
    side = broadcast_if_small(bad_slots)
    same = F.lit(True)
    for k in slot_keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_slot_{k}"))
    good = typed.join(side, on=same, how="left_anti").drop("_bad")
    rejected = (typed.join(side, on=same, how="left_semi")
                     .withColumn("reason", F.when(F.col("_bad"), F.lit("invalid value"))
                                 .otherwise(F.lit("slot rejected")))
                     .drop("_bad"))
    return good, rejected


def split_by_response(typed: DataFrame, slot_keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """All-or-nothing per landed response, one response per slot (O-13, O-14).

    Of the responses of a slot the first valid one is taken, later ones are
    not asked for any more; every invalid response goes whole to the dead
    letter, an unreadable one with its text.  ``typed`` should be
    materialized: three branches read it.
    """
    responses = typed.groupBy(*slot_keys, "response").agg(F.max("_bad").alias("_bad"))
    taken = responses.where("not _bad").groupBy(*slot_keys).agg(F.min("response").alias("response"))
    good = typed.join(taken.select("response"), "response", "left_semi").drop("_bad")
    failed = responses.where("_bad").select("response")
    reason = (F.when(F.col("unreadable").isNotNull(), F.lit("unreadable response"))
               .when(F.col("_bad"), F.lit("invalid value")).otherwise(F.lit("slot rejected")))
    rejected = typed.join(failed, "response", "left_semi").withColumn("reason", reason).drop("_bad")
    return good, rejected


def slot_status(typed: DataFrame, slot_keys: Sequence[str], bad: Column | str = "_bad") -> DataFrame:
    """Per slot: rows, bad rows and the accept/reject decision (O-13 summary)."""
    b = F.col(bad) if isinstance(bad, str) else bad
    return (typed.groupBy(*slot_keys)
                 .agg(F.count(F.lit(1)).alias("n_rows"),
                      F.sum(b.cast("int")).alias("n_bad"))
                 .withColumn("status", F.when(F.col("n_bad") > 0, F.lit("rejected"))
                             .otherwise(F.lit("accepted"))))


def retry_queue(failures: DataFrame, slot_keys: Sequence[str],
                max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """Failed attempts per slot: fewer than ``max_attempts`` -> retry, else
    dead letter (O-18)."""
    return (failures.groupBy(*slot_keys).agg(F.count(F.lit(1)).alias("attempts"))
                    .withColumn("status", F.when(F.col("attempts") < max_attempts, F.lit("retry"))
                                .otherwise(F.lit("dead_letter"))))


def next_period(collected: DataFrame, keys: Sequence[str], year: str = "year",
                month: str = "month") -> DataFrame:
    """Latest collected month per key and the month to ask for next (O-17)."""
    last = F.max(F.make_date(F.col(year), F.col(month), F.lit(1)))
    nxt = F.add_months(F.col("last_period"), 1)
    return (collected.groupBy(*keys).agg(last.alias("last_period"))
                     .select(*keys, F.year("last_period").alias("last_year"),
                             F.month("last_period").alias("last_month"),
                             F.year(nxt).alias("next_year"), F.month(nxt).alias("next_month")))
