"""visitflow: e-commerce visit and ad-click analytics as Spark DataFrame and Structured Streaming
jobs.  See README.md for the operator list."""

from visitflow.config import build_session, checkpoint_root
from visitflow.operators import (
    ad_minute_counts, ad_trend, blacklist_candidates, category_click_events, category_counts,
    daily_ad_counts, filter_blacklisted, province_top_ads, region_ad_counts, sample_sessions,
    session_detail, session_histogram, session_histogram_share, session_summary, top_categories,
    top_sessions_per_category, user_ad_counts, visits_in_range,
)
from visitflow.plans import ad_report, session_job
from visitflow.sources import load_blacklist, load_users, load_visits, parse_clicks, read_click_stream
from visitflow.streaming import start_ad_stream

__version__ = "0.1.0"

__all__ = [
    "ad_minute_counts", "ad_report", "ad_trend", "blacklist_candidates", "build_session",
    "category_click_events", "category_counts", "checkpoint_root", "daily_ad_counts",
    "filter_blacklisted", "load_blacklist", "load_users", "load_visits", "parse_clicks",
    "province_top_ads", "read_click_stream", "region_ad_counts", "sample_sessions", "session_detail",
    "session_histogram", "session_histogram_share", "session_job", "session_summary",
    "start_ad_stream", "top_categories", "top_sessions_per_category", "user_ad_counts",
    "visits_in_range",
]
