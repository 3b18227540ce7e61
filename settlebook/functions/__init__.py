from settlebook.functions.money import (  # noqa: F401
    MONEY, TOTAL, cents_to_units, dec_lit, decimals_to_double, money,
)
from settlebook.functions.timez import (  # noqa: F401
    LOCAL_TZ, effective_before, effective_local, floor_second, local_at_or_after,
    local_at_or_before, local_before, local_between, local_to_utc, local_ts, ts_lit,
)
