"""Registered queries: the jobs and operators applied to the given tables, and the same definitions as plain SQL."""

from registry.core import REG  # noqa: E402
from registry import boards, logistics, retail, realtime, operators  # noqa: E402,F401

__all__ = ["REG"]
