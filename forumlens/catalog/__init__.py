"""Every operator as a named query over the given tables, with equivalent SQL where there is one."""

from forumlens.catalog.base import ORACLES, QUERIES
from forumlens.catalog import (  # noqa: F401  (registration)
    analytics, collecting, files, jobs, reporting, streams,
)

__all__ = ["ORACLES", "QUERIES"]
