"""Named query plans (Spark) and their DuckDB oracle twins."""

from __future__ import annotations

import importlib

from panelforge.plans.registry import REGISTRY

_MODULES = ("q_panel", "q_split", "q_model", "q_gates", "q_ingest", "q_sinks", "q_squad", "q_models", "q_stream", "q_flow")


def load_all():
    for m in _MODULES:
        importlib.import_module(f"panelforge.plans.{m}")
    return REGISTRY
