"""All registered queries by name."""

from __future__ import annotations

from cohortflow.catalog import etl, features, sources, statistics, synthetic, training
from cohortflow.catalog.base import Query

REGISTRY: dict[str, Query] = {}
for _module in (etl, sources, statistics, features, synthetic, training):
    REGISTRY.update(_module.QUERIES)
