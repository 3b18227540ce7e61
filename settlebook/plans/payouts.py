"""Payout snapshot as of per-currency cutoffs, and payout buckets per
(event, currency)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from settlebook.functions.timez import before, day_of, effective_before, local_before, local_between, ts_lit
from settlebook.operators import Bucket, KeySet, combine_bucket_sums, exists_flag, newest, not_in, partial_bucket_sums, set_facts
from settlebook.plans import rules as R
from settlebook.plans.period import Period

NEWEST_FIRST = ("changed", "log_position")


def _any(cols) -> Column:
    return reduce(lambda a, b: a | b, cols)


def _all(cols) -> Column:
    return reduce(lambda a, b: a & b, cols)


def cutoff_matrix(period: Period) -> Column:
    """Which change-log rows may represent a payout at the period end.

    One arm per rule: ACH created in the current regime, per currency group
    (created between the regime start and the group's cutoff, effective date
    and last change before it); ACH from the old regime; checks; wires.
    """
    tz = period.tz
    created, changed = F.col("created"), F.col("changed")
    eff = ["trx_date", "created"]
    currency, status = F.col("currency"), F.col("status")
    ach_arms = [
        _all([local_between(created, period.ach_regime_from, w.created_to, tz),
              effective_before(eff, w.before, tz),
              changed < ts_lit(w.before),
              currency.isin(*w.currencies)])
        for w in period.ach_windows
    ]
    ach_arms.append(_all([local_before(created, period.ach_regime_from, tz),
                          changed < ts_lit(period.ach_old_changed_before),
                          currency.isin(*R.ACH_OLD_CURRENCIES)]))
    ach = (F.col("payout_type") == R.ACH) & ~status.isin(*R.ACH_EXCLUDED_STATUSES) & _any(ach_arms)
    check = _all([F.col("payout_type") == R.CHECK,
                  (status != 0) & F.col("status_old").isNotNull(), status != R.WIRE_STATUS,
                  effective_before(eff, period.check_before, tz),
                  changed < ts_lit(period.check_before),
                  currency.isin(*R.ALL_PAYOUT_CURRENCIES)])
    wire = _all([status == R.WIRE_STATUS,
                 local_before(created, period.wire_before, tz),
                 changed < ts_lit(period.wire_before),
                 currency.isin(*R.ALL_PAYOUT_CURRENCIES)])
    return ach | check | wire


def latam_rule(period: Period) -> Column:
    """BRL / ARS ACH payouts: own cutoffs on the raw change time, own status exclusions."""
    per_currency = [(F.col("currency") == cur) & (F.col("changed") < ts_lit(d))
                    for cur, d in period.latam_changed_before.items()]
    return ((F.col("payout_type") == R.ACH) & _any(per_currency)
            & ~F.col("status").isin(*R.LATAM_EXCLUDED_STATUSES))


def payout_snapshot(history: DataFrame, current: DataFrame, manual_voids: DataFrame,
                    period: Period, exclude_against: str = "log") -> DataFrame:
    """OP7: one row per payout and source: the latest qualifying log version
    under each of the two rule families, plus current payouts the log never
    saw (``exclude_against="log"``), or of which it holds no version that
    qualifies for either family (``"filtered"``: VAR3).

    Plan: a single aggregate per ``payout_id`` (partial, so a hot payout is
    folded map-side) of the log rows that qualify for anything yields the newest version under the cutoff
    matrix, the newest under the BRL/ARS rule and whether the payout was ever
    wired; it has exactly one consumer, so the log is shuffled once at full
    width. Its row is exploded into one row per rule family.

    The BRL/ARS family's ``payout_id NOT IN (payouts ever wired)`` tests the
    ranking key against a set made of whole groups of the same aggregate, so
    membership is the row's own wired flag. The manual-void NOT IN is a flag
    join against that (small) table. The NULL / empty cases of all sets come
    from one job over the id columns (:func:`~settlebook.operators.set_facts`),
    run when the plan is built. Current payouts are anti-joined against the distinct ids of
    the whole log (one narrow column): a payout that the log holds only in
    versions that never qualify is known to it all the same.

    The UNION's duplicate removal is exact without a shuffle of the
    snapshot: log rows are unique per payout and family, a BRL/ARS row can
    only repeat the matrix row of its own payout (compared in place), and
    current rows carry another ``source``; only the current branch is
    de-duplicated.
    """
    cols = [c for c in R.SNAPSHOT_COLUMNS if c != "source"]
    payload = [c for c in cols if c not in NEWEST_FIRST and c != "payout_id"]
    # Rows that no aggregate below looks at cannot change it: dropped at the
    # scan, before they are sorted and shuffled at full width.
    wired = F.col("status") == R.WIRE_STATUS
    matters = history.where(cutoff_matrix(period) | latam_rule(period) | wired)
    per_payout = matters.groupBy("payout_id").agg(
        newest(NEWEST_FIRST, payload, cutoff_matrix(period)).alias("_matrix"),
        newest(NEWEST_FIRST, payload, latam_rule(period)).alias("_latam"),
        F.max(F.when(wired, 1).otherwise(0)).alias("_wired"))

    pid = F.col("payout_id")
    if exclude_against not in ("log", "filtered"):
        raise ValueError(f"exclude_against: {exclude_against!r}")
    known = KeySet(history, "payout_id", cutoff_matrix(period) | latam_rule(period) if exclude_against == "filtered" else None)
    # Facts of the three NOT IN sets: one job, two of them in one pass over the log's ids.
    facts = set_facts(wired=KeySet(history, "payout_id", wired), logged=known, voided=KeySet(manual_voids, "payout_id"))

    def outside(name: str, member: Column) -> Column:
        if facts[name].nulls:
            return F.lit(False)
        return pid.isNotNull() & ~member if facts[name].rows else F.lit(True)

    not_wired = outside("wired", F.col("_wired") == 1)
    latam_ok = (F.col("_latam").isNotNull() & ~F.col("_latam").eqNullSafe(F.col("_matrix")) & not_wired)
    rows = per_payout.select(pid, F.explode(F.array(
        F.struct(F.lit(True).alias("matrix"), F.col("_matrix").alias("v")),
        F.struct(F.lit(False).alias("matrix"), F.when(latam_ok, F.col("_latam")).alias("v")))).alias("_r"))
    rows = rows.select(pid, F.col("_r.matrix").alias("_is_matrix"), F.col("_r.v").alias("_v")) \
               .where(F.col("_v").isNotNull())

    void_ids = manual_voids.select(F.col("payout_id").alias("_void"))
    rows = exists_flag(rows, "payout_id", void_ids, "_voided", "_void")
    logged = rows.where(F.col("_is_matrix") | outside("voided", F.col("_voided"))).select(
        pid, *[F.col(f"_v.{c}").alias(c) for c in cols if c != "payout_id"], F.lit("history_payout").alias("source"))

    fresh = current.where(before("created", period.payouts_created_before, day_of(current, "created")))
    fresh = not_in(fresh, "id", known.keys(), "payout_id", facts=facts["logged"])
    fresh = fresh.select(
        *[F.col("id").alias("payout_id") if c == "payout_id" else
          F.col("event").alias("event_id") if c == "event_id" else
          F.lit(None).cast("int").alias("status_old") if c == "status_old" else F.col(c)
          for c in cols],
        F.lit("payout").alias("source"))
    return logged.select(*cols, "source").unionByName(fresh.distinct())


def payout_bucket_rules(currency: Column) -> list[Bucket]:
    """The payout buckets, in output order. ``currency`` is the currency the
    BRL/ARS tests look at."""
    pt, st, old = F.col("payout_type"), F.col("status"), F.col("status_old")
    ws, reason = F.col("withheld_status"), F.col("reason")
    ach, check = pt == R.ACH, pt == R.CHECK
    latam = currency.isin(*R.LATAM_CURRENCIES)
    not_latam = ~currency.isin(*R.LATAM_CURRENCIES)
    withheld = st == R.WITHHELD_STATUS
    in_file = withheld & (old == R.WITHHELD_IN_FILE_OLD_STATUS)
    not_in_file = withheld & ((old != R.WITHHELD_IN_FILE_OLD_STATUS) | old.isNull())
    flagged = ws.isin(*R.WITHHELD_REASON_CODES) | reason.isin(*R.OTHER_FRAUD_REASONS)
    other_fraud = ws.isNull() & reason.isin(*R.OTHER_FRAUD_REASONS)
    b = [
        Bucket("ach_confirmed_in_file",
               ach & ((not_latam & (st.isin(*R.ACH_CONFIRMED_STATUSES) | (in_file & flagged)))
                      | (latam & (st.isin(*R.ACH_CONFIRMED_STATUSES_LATAM) | (in_file & flagged))))),
        Bucket("ach_paid_out_in_file",
               ach & ((latam & (st == 1)) | (not_latam & st.isin(*R.PAID_OUT_STATUSES)))),
    ]
    for label, cond in (("in_file", in_file), ("not_in_file", not_in_file)):
        b += [Bucket(f"ach_withheld_{kind}_{label}", ach & cond & (ws == code)) for kind, code in R.WITHHELD_KINDS]
        b.append(Bucket(f"ach_withheld_other_fraud_{label}", ach & cond & other_fraud))
    b += [Bucket(f"ach_{kind}_in_file", ach & (st == code), sign=-1) for kind, code in R.ACH_REVERSALS]
    b += [
        Bucket("wire_paid_out", st == R.WIRE_STATUS),
        Bucket("check_written", check & (st != R.WIRE_STATUS)),
        Bucket("check_completed", st.isNotNull() & check & st.isin(*R.PAID_OUT_STATUSES)),
        Bucket("check_withheld", check & withheld & (ws.isin(*R.WITHHELD_REASON_CODES) | other_fraud)),
        Bucket("check_deleted", check & (st == 3)),
        Bucket("check_voided", check & (st == 4), sign=-1),
        Bucket("check_reissued_returned", check & st.isin(6, 7), sign=-1),
    ]
    assert tuple(x.name for x in b) == R.PAYOUT_BUCKETS
    return b


def payout_sums(snapshot: DataFrame) -> DataFrame:
    """The payouts summed into buckets per (event_id, currency, user_id): a
    partial aggregate, so a hot event is folded before the shuffle."""
    buckets = payout_bucket_rules(F.col("currency"))
    return (snapshot.groupBy("event_id", "currency", "user_id")
                    .agg(*partial_bucket_sums(buckets, F.col("amount")))
                    .withColumn("_matched", F.lit(True)))


def payout_buckets(net_sales: DataFrame, snapshot: DataFrame | None = None, sums: DataFrame | None = None) -> DataFrame:
    """OP8: net sales full-outer-joined with the payout snapshot on (event,
    currency), payouts summed into buckets per (event, ..., organiser). ``sums``
    are those of :func:`payout_sums`, if they are there already.

    The many side is pre-aggregated per (event_id, currency, user_id), then
    joined and re-aggregated. This equals the direct join-then-group because the
    net-sales side has one row per (event_id, currency); unmatched net-sales rows
    get 0 (what the single all-NULL joined row contributes in the direct form)."""
    buckets = payout_bucket_rules(F.col("currency"))
    p = payout_sums(snapshot) if sums is None else sums
    e, pa = net_sales.alias("e"), p.alias("p")
    j = e.join(pa, (F.col("e.event_id") == F.col("p.event_id")) & (F.col("p.currency") == F.col("e.currency")),
               "full_outer")
    keyed = j.select(
        F.coalesce("e.event_id", "p.event_id").alias("event_id"),
        F.col("e.current_status").alias("current_status"),
        F.col("e.account_type").alias("account_type"),
        F.col("e.end_date").alias("end_date"),
        F.coalesce("e.org_uid", "p.user_id").alias("org_uid"),
        F.coalesce("e.currency", "p.currency").alias("currency"),
        F.col("e.epp_net_sales").alias("epp_net_sales"),
        F.col("e.offline_net_sales").alias("offline_net_sales"),
        *[F.col(f"p.{x.name}").alias(x.name) for x in buckets],
        F.col("p._matched").alias("_matched"))
    return keyed.groupBy(*R.PAYOUT_LEVEL_KEYS).agg(*combine_bucket_sums(buckets, F.col("_matched").isNotNull()))
