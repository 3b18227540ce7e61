from settlebook.plans.balance import balance  # noqa: F401
from settlebook.plans.charges import charge_buckets, charge_snapshot  # noqa: F401
from settlebook.plans.closing import Close, close_period  # noqa: F401
from settlebook.plans.edge_cases import multi_processor_events, payment_type_sets  # noqa: F401
from settlebook.plans.net_sales import (  # noqa: F401
    apply_payment_options, combined_net_sales, history_net_sales, itemized_net_sales, merge_net_sales,
    with_parent,
)
from settlebook.plans.payouts import payout_buckets, payout_snapshot  # noqa: F401
from settlebook.plans.period import FIXTURE, AchWindow, Period  # noqa: F401
