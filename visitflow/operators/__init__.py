"""DataFrame-in, DataFrame-out operators."""

from visitflow.operators.ads import (
    ad_minute_counts, ad_trend, blacklist_candidates, daily_ad_counts, filter_blacklisted,
    province_top_ads, region_ad_counts, user_ad_counts,
)
from visitflow.operators.categories import (
    category_click_events, category_counts, session_detail, top_categories,
    top_sessions_per_category,
)
from visitflow.operators.sessions import (
    sample_sessions, session_histogram, session_histogram_share, session_summary, visits_in_range,
)

__all__ = [
    "ad_minute_counts", "ad_trend", "blacklist_candidates", "category_click_events",
    "category_counts", "daily_ad_counts", "filter_blacklisted", "province_top_ads",
    "region_ad_counts", "sample_sessions", "session_detail", "session_histogram",
    "session_histogram_share", "session_summary", "top_categories", "top_sessions_per_category",
    "user_ad_counts", "visits_in_range",
]
