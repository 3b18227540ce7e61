"""Period parameters: every date a month-end close depends on."""

from __future__ import annotations

import json
import tomllib
from dataclasses import dataclass, field, fields
from datetime import datetime

from settlebook.functions.timez import LOCAL_TZ
from settlebook.plans import rules as R


@dataclass(frozen=True)
class AchWindow:
    """ACH payouts created (local) in [created_from, created_to] whose
    effective date (local) and raw ``changed`` are before ``before``."""
    currencies: tuple[str, ...]
    created_to: str
    before: str


@dataclass(frozen=True)
class Period:
    # Order history / current orders (net sales from the order log).
    history_from: str
    history_split: str
    # Itemized net sales window [itemized_from, itemized_to).
    itemized_from: str
    itemized_to: str
    # Payment options as of.
    options_before: str
    # Payout snapshot.
    ach_regime_from: str
    ach_windows: tuple[AchWindow, ...]
    ach_old_changed_before: str
    check_before: str
    wire_before: str
    latam_changed_before: dict = field(default_factory=dict)
    payouts_created_before: str = ""
    # Invoice charges.
    charges_created_before: str = ""
    charges_settled_from: str = ""
    charges_settled_before: str = ""
    tz: str = LOCAL_TZ

    def __post_init__(self) -> None:
        """Every date is there and readable, every window runs forward."""
        def at(name: str, value) -> datetime:
            try:
                return datetime.fromisoformat(value)
            except (TypeError, ValueError):
                raise ValueError(f"{name}: not a date or timestamp: {value!r}") from None

        dates = {f.name: at(f.name, getattr(self, f.name)) for f in fields(self)
                 if f.name not in ("ach_windows", "latam_changed_before", "tz")}
        for low, high in (("history_from", "history_split"), ("itemized_from", "itemized_to"),
                          ("charges_settled_from", "charges_settled_before")):
            if dates[low] >= dates[high]:
                raise ValueError(f"{high}: must be after {low}")
        if not self.ach_windows:
            raise ValueError("ach_windows: at least one window is needed")
        for i, w in enumerate(self.ach_windows):
            if not w.currencies:
                raise ValueError(f"ach_windows[{i}].currencies: empty")
            at(f"ach_windows[{i}].before", w.before)
            if at(f"ach_windows[{i}].created_to", w.created_to) < dates["ach_regime_from"]:
                raise ValueError(f"ach_windows[{i}].created_to: before ach_regime_from")
        if missing := [c for c in R.LATAM_CURRENCIES if c not in self.latam_changed_before]:
            raise ValueError(f"latam_changed_before: no cutoff for {', '.join(missing)}")
        for cur, value in self.latam_changed_before.items():
            at(f"latam_changed_before.{cur}", value)

    @staticmethod
    def from_dict(values: dict) -> Period:
        """A period from plain values (as in a JSON or TOML file); unknown and
        missing fields are errors that name the field."""
        known = {f.name for f in fields(Period)}
        if unknown := sorted(set(values) - known):
            raise ValueError(f"{unknown[0]}: unknown field")
        if missing := sorted(known - set(values) - {"tz"}):
            raise ValueError(f"{missing[0]}: missing")
        values = dict(values)
        windows = []
        for i, w in enumerate(values["ach_windows"]):
            if set(w) != {"currencies", "created_to", "before"}:
                raise ValueError(f"ach_windows[{i}]: needs currencies, created_to and before")
            windows.append(AchWindow(tuple(w["currencies"]), str(w["created_to"]), str(w["before"])))
        values["ach_windows"] = tuple(windows)
        values["latam_changed_before"] = {c: str(v) for c, v in values["latam_changed_before"].items()}
        return Period(**{k: v if k in ("ach_windows", "latam_changed_before") else str(v) for k, v in values.items()})

    @staticmethod
    def from_file(path: str) -> Period:
        """A period from a JSON or (by its ending) TOML file on the driver."""
        with open(path, "rb") as f:
            return Period.from_dict(tomllib.load(f) if path.endswith(".toml") else json.load(f))

    @staticmethod
    def dec_2018() -> Period:
        """The December 2018 close, with the dates of the original worksheet."""
        return Period(
            history_from="2013-05-13 13:30:06",
            history_split="2018-01-01",
            itemized_from="2018-01-01",
            itemized_to="2019-01-01",
            options_before="2019-01-01",
            ach_regime_from="2017-01-01",
            ach_windows=(
                AchWindow(R.ACH_NEW_GROUPS["main"], "2019-01-03", "2019-01-03"),
                AchWindow(R.ACH_NEW_GROUPS["gbp"], "2018-12-29", "2018-12-29"),
                AchWindow(R.ACH_NEW_GROUPS["eur"], "2019-01-01", "2019-01-01"),
            ),
            ach_old_changed_before="2019-01-01",
            check_before="2019-01-01",
            wire_before="2019-01-01",
            latam_changed_before={"BRL": "2019-01-01", "ARS": "2018-12-29"},
            payouts_created_before="2019-01-01",
            charges_created_before="2019-01-01",
            charges_settled_from="2013-08-14 03:13:18",
            charges_settled_before="2019-05-01",
        )

    @staticmethod
    def driver_fixture() -> Period:
        """Dates that fall inside the driver's generated tables: orders and
        line items span 1995-2001, the change-log ``events`` span January 2024.
        Offsets between the payout cutoffs follow the December 2018 close
        (main ACH group +2 days, GBP and ARS -3 days)."""
        return Period(
            history_from="1995-06-01",
            history_split="1999-01-01",
            itemized_from="1999-01-01",
            itemized_to="2000-01-01",
            options_before="2024-01-23",
            ach_regime_from="2024-01-10",
            ach_windows=(
                AchWindow(R.ACH_NEW_GROUPS["main"], "2024-01-25", "2024-01-25"),
                AchWindow(R.ACH_NEW_GROUPS["gbp"], "2024-01-20", "2024-01-20"),
                AchWindow(R.ACH_NEW_GROUPS["eur"], "2024-01-23", "2024-01-23"),
            ),
            ach_old_changed_before="2024-01-23",
            check_before="2024-01-23",
            wire_before="2024-01-23",
            latam_changed_before={"BRL": "2024-01-23", "ARS": "2024-01-20"},
            payouts_created_before="2024-01-23",
            charges_created_before="2001-01-01",
            charges_settled_from="1996-06-01",
            charges_settled_before="2001-06-01",
        )


FIXTURE = Period.driver_fixture()
