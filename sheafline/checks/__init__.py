"""Queries over the driver tables, each paired with the SQL that must agree with it."""

from sheafline.checks import (  # noqa: F401
    discovery_checks,
    full_record_checks,
    graph_checks,
    harvest_checks,
    outcome_checks,
    record_checks,
    scalar_checks,
    stream_checks,
)
from sheafline.checks.base import CHECKS  # noqa: F401
