"""The registered queries; importing the package registers them all."""

from swinglake.catalog import columns, landing, motion, swings, tables  # noqa: F401
from swinglake.catalog.registry import ENTRIES

__all__ = ["ENTRIES"]
