"""Sources: visit/user/blacklist tables, click lines (files or Kafka), driver-table adapters."""

from visitflow.sources.adapters import (
    ad_clicks_from_tables, click_lines, load_driver_clicks, load_driver_inputs, read_table,
    users_from_customer, visits_from_events,
)
from visitflow.sources.clicks import (
    click_line, parse_click_lines, parse_clicks, read_click_files, read_click_stream, with_click_time,
)
from visitflow.sources.tables import load_blacklist, load_users, load_visits, read_jdbc, read_text_rows

__all__ = [
    "ad_clicks_from_tables", "click_line", "click_lines", "load_blacklist", "load_driver_clicks",
    "load_driver_inputs", "load_users", "load_visits", "parse_click_lines", "parse_clicks",
    "read_click_files", "read_click_stream", "read_jdbc", "read_table", "read_text_rows", "users_from_customer",
    "visits_from_events", "with_click_time",
]
