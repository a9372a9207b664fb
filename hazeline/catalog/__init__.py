"""All registered queries. Importing the modules fills the registry."""

from hazeline.catalog import (  # noqa: F401
    cleaning, functions, joining, learning, metrics, scans, series, streams, summaries, texts,
)
from hazeline.catalog.base import ORACLES, QUERIES  # noqa: F401
