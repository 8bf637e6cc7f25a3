"""All registered queries and SQL oracles, merged from the plan modules."""

from __future__ import annotations

from . import (basics, checked_sources, fit_facts, log_reports, ml_claims, ml_decompose, ml_recommend, ml_trees_text, model_facts, relational,
               splits)

_MODULES = [log_reports, relational, basics, splits, ml_claims, ml_recommend, ml_decompose,
            ml_trees_text, model_facts, checked_sources, fit_facts]


def all_queries() -> dict:
    out: dict = {}
    for m in _MODULES:
        out.update(m.QUERIES)
    return out


def all_oracles() -> dict:
    out: dict = {}
    for m in _MODULES:
        out.update(m.ORACLES)
    return out
