"""Settlement rules as data.

Everything under "Fixed values" must equal the rules of the accounting
worksheet this engine reproduces; it is stated as written there, in the
original order. Dates are *not* here: they belong to a :class:`Period`.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Fixed values
# ---------------------------------------------------------------------------

# Order history: statuses kept before ranking; the rank winner must then be 100.
ORDER_STATUSES_KEPT = (100, 200, 220, 400, 350, 300, 250)
ORDER_STATUS_PAID = 100
NET_SALES_PAYMENT_TYPES = ("eventbrite", "offline")
EPP_PAYMENT_TYPE = "eventbrite"
OFFLINE_PAYMENT_TYPE = "offline"

# Payment options of an event (columns of the options log): offline sales
# count only if the processor is accepted (now or formerly) and neither PayPal
# nor Authorize.net is.
ACCEPT_PROCESSOR = "accept_eventbrite"
ACCEPT_PROCESSOR_OLD = "accept_eventbrite_old"
ACCEPT_PAYPAL = "accept_paypal"
ACCEPT_AUTHNET = "accept_authnet"

# Itemized net sales: organiser components (cents) and offline deductions.
EPP_COMPONENTS = (
    "refund__ap_organizer__gts__epp",
    "refund__ap_organizer__org_to_att_tax__epp",
    "refund__ap_organizer__royalty__epp",
    "refund__ap_organizer__transfer__epp",
    "sale__ap_organizer__gts__epp",
    "sale__ap_organizer__org_to_att_tax__epp",
    "sale__ap_organizer__royalty__epp",
    "sale__ap_organizer__transfer__epp",
)
OFFLINE_DEDUCTIONS = (
    "sale__gtf_esf__offline",
    "sale__eb_tax__offline",
    "refund__gtf_esf__offline",
    "refund__eb_tax__offline",
)

# Multi-processor edge cases.
EDGE_EXCLUDED_PAYMENT_TYPES = ("free", "manual")
EDGE_PROCESSOR_COMBOS = (
    "eventbrite,google",
    "eventbrite,paypal",
    "eventbrite,google,offline",
    "eventbrite,offline,paypal",
)

# Payout snapshot.
ACH = "ACH"
CHECK = "CHECK"
ACH_EXCLUDED_STATUSES = (0, 10, 12, 1, 8)
LATAM_CURRENCIES = ("BRL", "ARS")
LATAM_EXCLUDED_STATUSES = (0, 10, 12, 2)
ACH_NEW_GROUPS = {
    "main": ("AUD", "CAD", "NZD", "USD", "HKD", "SGD"),
    "gbp": ("GBP",),
    "eur": ("EUR",),
}
ACH_OLD_CURRENCIES = ("AUD", "CAD", "EUR", "GBP", "NZD", "USD", "SGD", "HKD", "MXN")
ALL_PAYOUT_CURRENCIES = ("AUD", "CAD", "EUR", "GBP", "NZD", "USD", "BRL", "ARS", "MXN", "SGD", "HKD")
CHARGE_CURRENCIES = ("ARS", "AUD", "BRL", "CAD", "EUR", "GBP", "NZD", "USD", "HKD", "SGD", "MXN")
WIRE_STATUS = 8

# Payout buckets.
ACH_CONFIRMED_STATUSES = (0, 1, 2, 3, 4, 6, 7, 10, 11, 12, 13)
ACH_CONFIRMED_STATUSES_LATAM = (1, 3, 4, 6, 7, 11, 13)
PAID_OUT_STATUSES = (0, 1, 2, 10, 11, 12, 13)
WITHHELD_STATUS = 5
WITHHELD_IN_FILE_OLD_STATUS = 2
WITHHELD_REASON_CODES = (1, 2, 4, 5)
OTHER_FRAUD_REASONS = (6, 7)
WITHHELD_KINDS = (
    ("fraud", 2),
    ("trust_safety", 4),
    ("canceled_event", 5),
    ("ach_recoup", 1),
)
ACH_REVERSALS = (("deleted", 3), ("voided", 4), ("returned", 6), ("reissued", 7))

# Charge buckets.
BACKUP_FUNDING_TYPES = ("CREDIT_BACKUP_FUNDING", "CHARGE_UNDERPAYMENT_REFUND")
CREDIT_BALANCE_TRANSFER = "CREDIT_BALANCE_TRANSFER"
CHARGE_BALANCE_TRANSFER = "CHARGE_BALANCE_TRANSFER"
TOTAL_ALWAYS_TYPES = ("CREDIT_BACKUP_FUNDING", "CREDIT_BALANCE_TRANSFER", "CHARGE_BALANCE_TRANSFER")
CHARGE_CATEGORIES = (
    ("charge_attendee_disputes", ("CHARGE_ATTENDEE_DISPUTES",)),
    ("charge_chargeback_loss", ("CHARGE_CHARGEBACK_LOSS",)),
    ("crabapple", ("CREDIT_SITE_OUTAGE", "CREDIT_FEE_CREDIT-CrabApple", "CREDIT_FEE_CREDIT - CrabApple")),
    ("equipment", ("CHARGE_SHIPPING_FEE", "ATD Card Reader", "CHARGE_SCANNER_RENTAL", "Shipping Fee",
                   "Scanner Rental", "CREDIT_ATD_CARD_READER", "CHARGE_ONSITE_TECHNOLOGY")),
    ("fee_credit", ("Fee Credit", "CREDIT_FEE_CREDIT", "CREDIT_REFUND_OVERCHARGED_FEES")),
    ("fees_revenue", ("Ticket Fee", "Printed Tickets Fee")),
    ("marketing_referral", ("Marketing Referral",)),
    ("miscellaneous", ("CHARGE_OTHER", "Equipment Problems", "CREDIT_REFERRAL_CREDIT",
                       "CREDIT_DISSATISFIED_CUSTOMER", "CREDIT_OTHER", "CHARGE_FEE_CORRECTION",
                       "Referral Credit", "CHARGE_LOST_DAMAGED_EQUIPMENT", "CREDIT_PAYOUT_ISSUE",
                       "CHARGE_STAFFING_ACCOUNT_MANAGEMENT", "Dissatisfied Customer",
                       "Lost/Damaged Equipment", "CREDIT_BUG", "Adjustment", "CREDIT_EQUIPMENT_PROBLEMS",
                       "CREDIT_REFUNDS_AFTER_INVOICE", "CREDIT_OVERPAYMENT_FOR_ATTENDEE_REFUNDS",
                       "CHARGE_ADDITIONAL_PAYMENT_PROCESSING_FEE", "CHARGE_REFUNDS_AFTER_INVOICE",
                       "Payout Issue", "Bug", "Refunds After Invoice Issued", "CHARGE_LATE_FEES", "Other")),
    ("rfid", ("CHARGE_RFID_CHIPS",)),
    ("old", ("CHARGE_TEMPORARY_REFUND_RESERVE", "CHARGE_EVENT_PROMOTION_RALLY", "Transfer Charge",
             "CHARGE_OTHER_INVOICES", "Refund", "Attendee Disputes", "Mailchimp", "Transfer Credit",
             "Site Outage", "Payout transaction charge", "Setup Fee", "payout transaction charge",
             "Chargeback Loss")),
    ("staffing", ("CHARGE_STAFFING_FIELD_OPERATIONS", "CHARGE_ONSITE_SERVICE")),
    ("charge_brand_pages", ("CHARGE_BRAND_PAGES",)),
    ("charge_event_promotion_algorithmic", ("CHARGE_EVENT_PROMOTION_ALGORITHMIC",)),
    ("charge_recoup_upfront_recoupment", ("CHARGE_RECOUPABLE_UPFRONT_RECOUPMENT",)),
)

# Balance: the terms that add up to the amount owed (the other buckets are
# informational).
BALANCE_TERMS = (
    "epp_net_sales",
    "offline_net_sales",
    "ach_confirmed_in_file",
    "ach_voided_in_file",
    "ach_deleted_in_file",
    "ach_returned_in_file",
    "ach_reissued_in_file",
    "wire_paid_out",
    "check_written",
    "check_reissued_returned",
    "check_voided",
    "check_deleted",
    "credits_charges_total",
)

# December 2018 close: payouts voided by hand (never uploaded to the bank).
DEC_2018_MANUAL_VOIDS_BRL = (
    7878303, 7882802, 7882803, 7884094, 7884095, 7884096, 7884098, 7884099, 7884100, 7884101,
    7884102, 7884104, 7884105, 7884107, 7884113, 7884114, 7884115, 7884116, 7884118, 7884123,
    7884124, 7884127, 7884129, 7884130, 7884135, 7884136, 7884137, 7884140, 7884141, 7884145,
    7884146, 7884151, 7884153, 7884154, 7884159, 7884161, 7884164, 7884166, 7884170, 7884172,
    7884174, 7884175, 7884183, 7884185, 7884186, 7884187, 7884189, 7884190, 7884194, 7884198,
    7884207, 7884208, 7884209, 7884211, 7884213, 7884214, 7884216, 7884224, 7884241, 7884242,
    7884244, 7884245, 7884247, 7884253, 7884267, 7884275, 7884277, 7884280, 7884282, 7884283,
    7884284, 7884285, 7884286, 7884289, 7884290, 7884291, 7884293, 7884294, 7884295,
)
DEC_2018_MANUAL_VOIDS_ARS = (
    7883590, 7884106, 7884110, 7884132, 7884139, 7884143, 7884149, 7884156, 7884163, 7884165,
    7884167, 7884168, 7884169, 7884184, 7884212, 7884215, 7884220, 7884227, 7884243, 7884268,
    7884269, 7884274, 7884276, 7884278, 7884279, 7884281, 7884288,
)

# ---------------------------------------------------------------------------
# Derived
# ---------------------------------------------------------------------------

PAYOUT_BUCKETS = (
    "ach_confirmed_in_file", "ach_paid_out_in_file",
    *[f"ach_withheld_{k}_in_file" for k, _ in WITHHELD_KINDS], "ach_withheld_other_fraud_in_file",
    *[f"ach_withheld_{k}_not_in_file" for k, _ in WITHHELD_KINDS], "ach_withheld_other_fraud_not_in_file",
    *[f"ach_{k}_in_file" for k, _ in ACH_REVERSALS],
    "wire_paid_out", "check_written", "check_completed", "check_withheld", "check_deleted",
    "check_voided", "check_reissued_returned",
)

FUNDING_BUCKETS = (
    "credit_backup_funding_total", "credit_balance_transfer_total", "charge_balance_transfer_total",
    "credit_backup_funding_not_applied", "credit_balance_transfer_not_applied",
    "charge_balance_transfer_not_applied", "credit_backup_funding_applied",
    "credit_balance_transfer_applied", "charge_balance_transfer_applied",
)
CHARGE_BUCKETS = FUNDING_BUCKETS + tuple(name for name, _ in CHARGE_CATEGORIES) + ("credits_charges_total",)

NET_SALES_DIMENSIONS = ("event_id", "current_status", "account_type", "end_date", "org_uid", "currency")
PAYOUT_LEVEL_KEYS = ("event_id", "current_status", "account_type", "end_date", "org_uid", "currency",
                     "epp_net_sales", "offline_net_sales")
PAYOUT_LEVEL_COLUMNS = PAYOUT_LEVEL_KEYS + PAYOUT_BUCKETS
EVENT_LEVEL_COLUMNS = PAYOUT_LEVEL_COLUMNS + CHARGE_BUCKETS

SNAPSHOT_COLUMNS = (
    "payout_id", "event_id", "user_id", "currency", "country", "payout_type", "trx_date", "created",
    "changed", "trx_id", "notes", "account_type", "reason", "status", "status_old", "amount",
    "payment_id", "withheld_status", "source",
)
