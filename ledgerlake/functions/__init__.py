from ledgerlake.functions.clock import now, today
from ledgerlake.functions.columns import (
    amount_in,
    amount_out,
    banded,
    initcap_trim,
    money,
    month_of,
    percent,
    quarter_of,
    ratio,
    weekday,
    year_of,
    years_between,
)
from ledgerlake.functions.draws import draw, md5_draw
from ledgerlake.functions.masking import MASKS, PRIVILEGED_ROLES, short_hash

__all__ = [
    "MASKS", "PRIVILEGED_ROLES", "amount_in", "amount_out", "banded", "draw", "initcap_trim",
    "md5_draw", "money", "month_of", "now", "percent", "quarter_of", "ratio", "short_hash",
    "today", "weekday", "year_of", "years_between",
]
