from __future__ import annotations

import datetime as dt
import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
# Python workers start with the environment of the JVM
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, [os.environ.get("PYTHONPATH")])])

from visitflow.config import build_session  # noqa: E402
from visitflow.schemas import VISIT_SCHEMA  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="visitflow-test-")
    session = build_session(
        master="local[*]",
        app_name="visitflow-tests",
        shuffle_partitions=8,
        extra={"spark.checkpoint.dir": os.path.join(scratch, "ckpt"),
               "spark.sql.warehouse.dir": os.path.join(scratch, "warehouse")},
    )
    yield session
    session.stop()


@pytest.fixture
def scratch_dir():
    return tempfile.mkdtemp(prefix="visitflow-case-")


def ts(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def visit(session_id, action_time, page_id=1, user_id=1, action="search", click=0, order=0, pay=0,
          keyword="", click_product=0, order_product=0, pay_product=0):
    t = ts(action_time)
    return (t.date(), user_id, session_id, t, action, pay, pay_product, click, click_product, order,
            order_product, keyword, page_id)


def visits_df(spark, rows, partitions: int | None = None):
    df = spark.createDataFrame(rows, VISIT_SCHEMA)
    return df.repartition(partitions) if partitions else df


def users_df(spark, ids):
    return spark.createDataFrame([(i,) for i in ids], "user_id long")


def range_results(spark, sf_dir):
    """The session operators over the visits of the registered time range, by query name."""
    import __spark_entry__ as entry
    from visitflow.operators import categories, sessions

    visits = entry._in_range(spark, sf_dir)
    summary = sessions.session_summary(visits)
    top = categories.top_categories(categories.category_counts(visits))
    events = categories.category_click_events(visits, top)
    return {
        "session_histogram": sessions.session_histogram(summary),
        "sample_sessions": sessions.sample_sessions(summary, n=entry.SAMPLE_SIZE, seed=entry.SAMPLE_SEED),
        "top_categories": top,
        "category_click_events": events,
        "top_sessions_per_category": categories.top_sessions_per_category(visits, top),
        "session_detail": categories.session_detail(visits, events),
    }
