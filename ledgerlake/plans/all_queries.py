"""Import every query module so that the registry is filled."""

from ledgerlake.plans import (  # noqa: F401
    queries_governance,
    queries_layers,
    queries_layout,
    queries_marts,
    queries_sources,
    queries_streams,
)
from ledgerlake.plans.registry import ORACLES, QUERIES  # noqa: F401
