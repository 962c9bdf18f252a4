"""All registered queries. Importing the modules registers what they define."""

from harborline.catalog import insurance, loads, profiles, reports, scalars, streams, taxi
from harborline.catalog.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES", "insurance", "loads", "profiles", "reports", "scalars", "streams", "taxi"]
