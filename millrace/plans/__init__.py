"""Registered queries, one module per operator family."""

from __future__ import annotations

from importlib import import_module

FAMILIES = ["scalars", "flow", "joins", "shape", "series", "streams"]


def load_all() -> None:
    for family in FAMILIES:
        import_module(f"millrace.plans.{family}")
