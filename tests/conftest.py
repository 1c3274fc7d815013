from __future__ import annotations

import dataclasses
import os
import sys
from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from eventloom.context import Ctx, TierRule  # noqa: E402
from eventloom.sources.events import EventSource  # noqa: E402
from eventloom.sources.schema import EVENTS  # noqa: E402
from fixture_bindings import FX_ROLES  # noqa: E402

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
AS_OF = date(2024, 1, 31)
SECOND = 1_000_000
MINUTE = 60 * SECOND


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def micros(day: int, hour: int = 12, minute: int = 0, second: int = 0, us: int = 0) -> int:
    """Micros of a moment in January 2024."""
    moment = datetime(2024, 1, 1, tzinfo=timezone.utc) + timedelta(days=day - 1, hours=hour, minutes=minute)
    return int(moment.timestamp()) * SECOND + second * SECOND + us


def event(user, name, at, **params):
    """An event row; parameters land in the slot of their Python type."""
    bag = []
    for key, value in params.items():
        slots = (
            value if isinstance(value, str) else None,
            value if isinstance(value, int) else None,
            value if isinstance(value, float) else None,
        )
        bag.append(("from" if key == "from_" else key, slots))
    day = datetime.fromtimestamp(at // SECOND, timezone.utc).strftime("%Y%m%d")
    return (user, name, at, bag, day)


@pytest.fixture
def context(spark):
    def make(intraday, daily=(), as_of=AS_OF, rule=TierRule()):
        sources = [EventSource(spark.createDataFrame(list(rows), EVENTS)) for rows in (intraday, daily)]
        return Ctx(sources[0], sources[1], as_of, FX_ROLES, rule)

    return make


def rows(df, *columns):
    """Rows of the named columns as sorted tuples."""
    picked = [tuple(r) for r in df.select(*columns).collect()]
    return sorted(picked, key=lambda r: tuple((v is not None, str(v)) for v in r))


def one(df) -> dict:
    (only,) = df.collect()
    return only.asDict()


def with_as_of(ctx: Ctx, as_of: date) -> Ctx:
    return dataclasses.replace(ctx, as_of=as_of)
