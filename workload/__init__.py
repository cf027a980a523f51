"""All named queries over the given tables."""

from workload import bank, cleaned, models  # noqa: F401
from workload.registry import ORACLES, QUERIES, full_sql  # noqa: F401
