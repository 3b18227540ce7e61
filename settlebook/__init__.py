"""settlebook: organiser balance (accounts-payable liability) on Spark DataFrames.

Layout
------
functions/  column-level helpers (wall-clock time zones, money)
operators/  reusable DataFrame operators (latest-as-of, null-aware NOT IN,
            existence flags, full-outer merges, distinct unions, rule-driven sums)
sources/    table loading and the adapters that derive the settlement-shaped
            tables from the driver's parquet tables
plans/      the settlement steps (net sales, payouts, charges, balance) and the
            period close that chains them
oracle/     DuckDB SQL used as an independent correctness oracle
"""

__all__ = ["__version__"]
__version__ = "0.1.0"
