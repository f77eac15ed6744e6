"""All registered queries."""

from motorpool.catalog import (  # noqa: F401
    goldqueries,
    ingestqueries,
    modelqueries,
    streamqueries,
    tripqueries,
    windowqueries,
)
from motorpool.catalog.registry import ORACLES, QUERIES  # noqa: F401
