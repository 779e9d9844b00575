from cardlens.functions.expressions import (
    cap_first, date_key, fill_zip, format_phone, full_address, month_name, month_of,
)
from cardlens.functions.money import LIMBS, merged_limbs, money_limbs, money_of_limbs, money_sum, money_total
from cardlens.functions.predicates import in_month, in_range

__all__ = [
    "LIMBS", "cap_first", "date_key", "fill_zip", "format_phone", "full_address", "in_month", "in_range",
    "merged_limbs", "money_limbs", "money_of_limbs", "money_sum", "money_total", "month_name", "month_of",
]
