"""Quoting for generated SQL expressions.

Hundreds of generated columns are written as SQL text: each is then one call to
the JVM instead of one per operator, which for a 464-column projection is seconds
of driver time on every (micro-)batch.
"""

from __future__ import annotations


def ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
