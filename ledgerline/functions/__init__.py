from ledgerline.functions.dates import cast_date, date_days, parse_date, render_date
from ledgerline.functions.ledger import (
    currency_class_sums, is_active, is_domestic, ledger_code, signed_movement)

__all__ = [
    "cast_date", "date_days", "parse_date", "render_date",
    "currency_class_sums", "is_active", "is_domestic", "ledger_code", "signed_movement",
]
