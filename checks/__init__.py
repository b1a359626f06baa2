"""Every operator as a query on the given tables, with its SQL counterpart where one exists."""

from __future__ import annotations

from checks.base import REGISTRY, Query  # noqa: F401
from checks import q_sources, q_supply, q_geo, q_models, q_fits, q_recomputed, q_plan, q_quality, q_offline  # noqa: F401,E402
