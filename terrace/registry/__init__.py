"""All registered queries. Importing the modules registers them."""

from terrace.registry import basics, layers, quality, sales, series, storage  # noqa: F401
from terrace.registry.common import ORACLE, QUERIES, runnable  # noqa: F401
