"""Named queries over the given tables."""

from __future__ import annotations

import importlib

MODULES = ("source_queries", "block_queries", "cohort_queries", "prep_queries", "evaluate_queries", "model_queries", "model_check_queries", "flow_queries")


def load_all() -> None:
    for m in MODULES:
        importlib.import_module(f"{__name__}.{m}")
