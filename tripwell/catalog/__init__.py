"""Every operator bound to the sample tables under one name.

Importing the modules fills the registry; ``queries()`` and ``oracle_sql()``
hand it out.
"""

from __future__ import annotations

from tripwell.catalog import (  # noqa: F401  (imported for their registrations)
    fares, grouping, ingest, resampling, shaping, summaries)
from tripwell.catalog.registry import oracle_sql, queries  # noqa: F401
