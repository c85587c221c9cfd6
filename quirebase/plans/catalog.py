"""The registered queries of the core and their SQL."""

from __future__ import annotations

import importlib
import pkgutil

import quirebase.plans as plans
from quirebase.plans.registry import QUERIES, SQL, Query

for _module in pkgutil.iter_modules(plans.__path__):
    if _module.name.startswith("q_"):
        importlib.import_module(f"quirebase.plans.{_module.name}")


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
