"""Registered queries over the driver tables, with their SQL counterparts."""

from __future__ import annotations

import importlib

from ledgerlake.workload.registry import QUERIES, Query

MODULES = ("sales_queries", "entity_queries", "operator_queries", "source_queries", "scalar_queries", "end_to_end")


def load_queries() -> dict[str, Query]:
    for module in MODULES:
        importlib.import_module(f"{__name__}.{module}")
    return dict(QUERIES)
