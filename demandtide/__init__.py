"""Demand-planning analytics as plain Spark DataFrame operators."""

from demandtide.session import build_session, written

__all__ = ["build_session", "written"]
