"""Collects the query catalog from every module that registers queries."""

from __future__ import annotations


def _load():
    from orderlens.plans import catalog  # noqa: F401  (registers on import)
    for mod in ("orderlens.plans.dashboard", "orderlens.plans.measures_q", "orderlens.plans.model_q",
                "orderlens.plans.ml_queries", "orderlens.plans.metrics_q", "orderlens.plans.models",
                "orderlens.plans.exports"):
        __import__(mod)
    return catalog


def all_queries():
    return dict(_load().QUERIES)


def all_oracles():
    return dict(_load().ORACLES)
