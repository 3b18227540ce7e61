"""Charge buckets from a rule table (a sparse form of OP10's sums).

Which charge types add up to which bucket is data: one row ``(charge_type,
bucket, needs, processed)`` per type and bucket. ``needs`` names the test that a
charge must pass (``settled``, ``changed`` or ``created`` before the close's
limit), ``processed`` the state it must be in (NULL: any); a NULL ``charge_type``
stands for every type. A new charge type is a new row, not a change of code.

Charges are joined with the rules and folded as (event, currency, bucket): a
charge makes a row per bucket that it counts for (two or three), where the dense
form evaluates two dozen IN lists for each. The wide row per (event, currency) is
made at the end, from the few buckets that it has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from settlebook.functions.timez import local_before
from settlebook.plans import rules as R
from settlebook.plans.charges import _SETTLED, with_settled
from settlebook.plans.period import Period

SCHEMA = "charge_type string, bucket string, needs string, processed int"
SETTLED, CHANGED, CREATED = "settled", "changed", "created"
TOTAL = "credits_charges_total"
MOST_BROADCAST = 100_000  # rules; beyond it the join is left to the planner


def default_rules() -> list[tuple]:
    """The buckets of ``plans.rules`` as rule rows."""
    families = (("credit_backup_funding", R.BACKUP_FUNDING_TYPES, CREATED), ("credit_balance_transfer", (R.CREDIT_BALANCE_TRANSFER,), CHANGED),
                ("charge_balance_transfer", (R.CHARGE_BALANCE_TRANSFER,), CHANGED))
    rows = [(t, f"{name}_{part}", needs, processed) for name, types, needs in families for t in types
            for part, processed in (("total", None), ("not_applied", 0), ("applied", 1))]
    rows += [(t, name, SETTLED, None) for name, types in R.CHARGE_CATEGORIES for t in types]
    return rows + [(None, TOTAL, SETTLED, None)] + [(t, TOTAL, CHANGED, None) for t in R.TOTAL_ALWAYS_TYPES]


def rules_table(spark: SparkSession, rows=None) -> DataFrame:
    return spark.createDataFrame(default_rules() if rows is None else rows, SCHEMA)


def checked_rules(rules: DataFrame) -> int:
    """The number of rules; an error names what no close can apply: unknown
    buckets or tests, missing values, and a rule that is there twice."""
    known = F.col("bucket").isin(*R.CHARGE_BUCKETS) & F.col("needs").isin(SETTLED, CHANGED, CREATED)
    bad = rules.where(~F.coalesce(known, F.lit(False)) | ~F.coalesce(F.col("processed").isin(0, 1), F.lit(True)))
    twice = rules.groupBy(*rules.columns).count().where("count > 1").drop("count")
    wrong = bad.unionByName(twice).limit(5).collect()
    if wrong:
        raise ValueError("charge rules that cannot be applied: " + "; ".join(str(tuple(r)) for r in wrong))
    return rules.count()


def sparse_charge_sums(charges: DataFrame, rules: DataFrame, period: Period) -> DataFrame:
    """``event_id, currency, bucket, amount``: a charge counts once for a bucket,
    however many rules lead it there."""
    tz = period.tz
    tests = with_settled(charges, period).select(
        F.col("event").alias("event_id"), "currency", "charge_type", F.col("processed").alias("_processed"), "amount",
        F.coalesce(F.col(_SETTLED), F.lit(False)).alias(SETTLED),
        F.coalesce(local_before("changed", period.charges_settled_before, tz), F.lit(False)).alias(CHANGED),
        F.coalesce(local_before("created", period.charges_settled_before, tz), F.lit(False)).alias(CREATED))
    # A row of rules per type: the join makes no more rows than there are charges.
    rule = F.struct("bucket", "needs", "processed")
    by_type = rules.where(F.col("charge_type").isNotNull()).groupBy("charge_type").agg(F.collect_list(rule).alias("_own"))
    for_all = rules.where(F.col("charge_type").isNull()).agg(F.collect_list(rule).alias("r")).scalar()
    if checked_rules(rules) <= MOST_BROADCAST:
        by_type = F.broadcast(by_type)
    joined = tests.join(by_type, "charge_type", "left").withColumn("_rules", F.concat(F.coalesce("_own", F.array().cast(
        "array<struct<bucket:string,needs:string,processed:int>>")), for_all))

    def holds(r):
        passed = F.when(r["needs"] == SETTLED, F.col(SETTLED)).when(r["needs"] == CHANGED, F.col(CHANGED)).otherwise(F.col(CREATED))
        return passed & (r["processed"].isNull() | F.coalesce(r["processed"] == F.col("_processed"), F.lit(False)))

    buckets = F.array_distinct(F.transform(F.filter("_rules", holds), lambda r: r["bucket"]))
    rows = joined.select("event_id", "currency", "amount", F.explode(buckets).alias("bucket"))
    return rows.groupBy("event_id", "currency", "bucket").agg(F.sum("amount").alias("amount"))


def charge_sums_by_rules(charges: DataFrame, rules: DataFrame, period: Period) -> DataFrame:
    """The same rows as :func:`settlebook.plans.charges.charge_sums`, by the rule
    table: a bucket is NULL where nothing counts for it, the total 0."""
    sparse = sparse_charge_sums(charges, rules, period)
    # every (event, currency) with charges has a row, also if no rule takes any of them
    there = charges.select(F.col("event").alias("event_id"), "currency").distinct().select("event_id", "currency", F.lit(None).cast("string").alias("bucket"),
                                                                                         F.lit(None).cast(sparse.schema["amount"].dataType).alias("amount"))
    wide = sparse.unionByName(there).groupBy("event_id", "currency").agg(*[F.max(F.when(F.col("bucket") == b, F.col("amount"))).alias(b) for b in R.CHARGE_BUCKETS])
    total = F.coalesce(F.col(TOTAL), F.lit(0).cast(wide.schema[TOTAL].dataType))
    return wide.withColumn(TOTAL, total).withColumn("_matched", F.lit(True))
