"""Shared intermediate tables, as the engine keeps them."""

from ..operators.scratch import drop, drop_all, release, root, save

__all__ = ["drop", "drop_all", "release", "root", "save"]
