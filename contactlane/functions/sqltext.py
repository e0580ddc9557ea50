"""Helpers to build Spark SQL expression text safely."""

from __future__ import annotations

import re


def sql_string(value: str) -> str:
    """Quote ``value`` as a Spark SQL string literal (backslash escapes on)."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def ident(name: str) -> str:
    """Quote a column or parameter name."""
    return "`" + name.replace("`", "``") + "`"


def format_message(template: str, args: dict[str, str]) -> str:
    """SQL for a message template such as ``'got {n}'`` with SQL argument text.

    The template's text parts and the arguments (cast to string) are
    concatenated; the arguments are non-NULL wherever a message is built.
    Templates without placeholders become plain literals.
    """
    import string

    parts = []
    for text, field, _, _ in string.Formatter().parse(template):
        if text:
            parts.append(sql_string(text))
        if field is not None:
            parts.append(f"CAST({args[field]} AS STRING)")
    if len(parts) == 1 and not any(f for _, f, _, _ in string.Formatter().parse(template)):
        return parts[0]
    return f"concat({', '.join(parts)})" if parts else "''"


_PLACEHOLDER = re.compile(r"<<(\w+)>>")


def fill(template: str, env: dict[str, str]) -> str:
    """Replace ``<<name>>`` placeholders of a SQL template with ``env[name]``."""
    return _PLACEHOLDER.sub(lambda m: env[m.group(1)], template)
