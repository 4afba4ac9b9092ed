"""Column-expression factories (all built-in Spark functions)."""

from ledgerlens.functions.scalar import (  # noqa: F401
    as_date_lit, as_ts_lit, clean_lower, clean_title, clean_upper, days_between,
    digits_and_plus, join_words, month_start, pct_of, quarter_start, safe_divide,
    utc_now, year_start,
)
from ledgerlens.functions.tiers import (  # noqa: F401
    deal_size_bin, deal_size_tier, kpi_status, lifetime_tier, rfm_segment, score_segment,
)
