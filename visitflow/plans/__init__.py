"""Batch jobs composed from the operators."""

from visitflow.plans.ad_report import ad_report
from visitflow.plans.counts import TableCounts
from visitflow.plans.session_job import session_job

__all__ = ["TableCounts", "ad_report", "session_job"]
