"""The month-end close: every step chained, with stages written on request.

DAG::

    itemized ─┐
              ├─ merged ─ parented ─ net_sales ─┐
    history ──┘                                  ├─ payout_level ─ event_level ─ balance
             payout_snapshot ─ payout_sums ─────┘   charge_snapshot ─ charge_sums ┘

Each step is a lazy DataFrame. With a ``store`` (see
``settlebook.sources.stages.StageStore``) every stage that it keeps is
written once and read back before the next stage uses it: a stage is computed
once however many later stages read it, lineage is cut at a table that any
executor can read again, and a later run can go on from the tables.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame

from settlebook.plans.balance import balance
from settlebook.plans.charges import charge_buckets, charge_snapshot, charge_sums
from settlebook.plans.net_sales import (
    apply_payment_options, history_net_sales, itemized_net_sales, merge_net_sales, with_parent,
)
from settlebook.plans.payouts import payout_buckets, payout_snapshot, payout_sums
from settlebook.plans.period import Period

if TYPE_CHECKING:
    from settlebook.sources.adapters import SettlementInputs


STAGES = ("itemized", "history", "merged", "parented", "net_sales", "payout_snapshot", "payout_sums", "payout_level",
          "charge_snapshot", "charge_sums", "event_level", "balance")

Store = Callable[[str, Callable[[], DataFrame]], DataFrame]


class Close:
    """The stages by name (``STAGES``), each planned when it is first asked for."""

    def __init__(self, x: "SettlementInputs", period: Period, store: Store | None = None):
        self.x, self.period = x, period
        self._keep: Store = store or (lambda name, make: make())
        self._made: dict[str, DataFrame] = {}

    def __getattr__(self, stage: str) -> DataFrame:
        if stage not in STAGES:
            raise AttributeError(stage)
        if stage not in self._made:
            self._made[stage] = self._keep(stage, getattr(self, f"_{stage}"))
        return self._made[stage]

    def _itemized(self) -> DataFrame:
        x = self.x
        return itemized_net_sales(x.order_itemizations, x.orders, x.events, x.users, x.event_exclusions, x.prior_event_level,
                                  x.transfer_orders, self.period)

    def _history(self) -> DataFrame:
        x = self.x
        return history_net_sales(x.history_orders, x.orders, x.events, x.users, x.transfer_orders, self.period)

    def _merged(self) -> DataFrame:
        return merge_net_sales(self.itemized, self.history)

    def _parented(self) -> DataFrame:
        return with_parent(self.merged, self.x.events)

    def _net_sales(self) -> DataFrame:
        return apply_payment_options(self.parented, self.x.history_payment_options, self.period)

    def _payout_snapshot(self) -> DataFrame:
        return payout_snapshot(self.x.history_payouts, self.x.payouts, self.x.manual_voids, self.period)

    def _payout_sums(self) -> DataFrame:
        return payout_sums(self.payout_snapshot)

    def _payout_level(self) -> DataFrame:
        return payout_buckets(self.net_sales, sums=self.payout_sums)

    def _charge_snapshot(self) -> DataFrame:
        return charge_snapshot(self.x.invoice_charges, self.period)

    def _charge_sums(self) -> DataFrame:
        return charge_sums(self.charge_snapshot, self.period)

    def _event_level(self) -> DataFrame:
        return charge_buckets(self.payout_level, None, self.x.wire_in_events, self.period, sums=self.charge_sums)

    def _balance(self) -> DataFrame:
        return balance(self.event_level)


def close_period(x: "SettlementInputs", period: Period, store: Store | None = None) -> Close:
    """The close of a period. Without a store its stages are planned on demand;
    with one (``store(name, make)`` returns the stage to go on from) all are
    made in order."""
    close = Close(x, period, store)
    if store is not None:
        for stage in STAGES:
            getattr(close, stage)
    return close
