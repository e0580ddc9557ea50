"""Python string semantics as Spark SQL expression text.

Each function takes the SQL text of a STRING expression and returns SQL text.
They are plain built-ins (trim, regexp_replace, rlike, initcap, ...) so they
stay inside the JVM; no Python runs per row.
"""

from __future__ import annotations

from .sqltext import sql_string

# Fixed value: the characters Python's str.isspace() accepts (Unicode
# White_Space plus the separators U+001C..U+001F, which Java's \s leaves out).
PY_WHITESPACE = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x20\x85\xa0\u1680"
                 "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
                 "\u2028\u2029\u202f\u205f\u3000")


def _escaped(chars: str) -> str:
    """``\\uXXXX`` escapes; Spark SQL string literals turn them into the characters."""
    return "".join(f"\\u{ord(c):04x}" for c in chars)


_WS_SET = "'" + _escaped(PY_WHITESPACE) + "'"            # SQL literal: the characters
_WS_CLASS = "'[" + _escaped(PY_WHITESPACE) + "]'"        # SQL literal: regex class
_NOT_WS_RUN = "'^([^" + _escaped(PY_WHITESPACE) + "]+)'"  # SQL literal: leading word
_NON_DIGIT_RE = r"(?U)\D"
# A "cased" character in Python's sense: upper, lower or title case letter.
_CASED = r"\p{IsUppercase}\p{IsLowercase}\p{IsTitlecase}"


def strip(x: str) -> str:
    """``str.strip()``: remove leading/trailing whitespace in Python's sense."""
    return f"trim(BOTH {_WS_SET} FROM {x})"


def is_blank_text(x: str) -> str:
    """A non-NULL ``x`` that is empty or only whitespace."""
    return f"({strip(x)} = '')"


def is_blank(x: str) -> str:
    """``not s or s.strip() == ''`` -- NULL, empty and whitespace-only."""
    return f"({x} IS NULL OR {is_blank_text(x)})"


def has_whitespace(x: str) -> str:
    """True when ``x`` contains a whitespace character (Python's sense)."""
    return f"({x} RLIKE {_WS_CLASS})"


def digits(x: str) -> str:
    """``re.sub(r'\\D', '', s)`` with Unicode decimal digits."""
    return f"regexp_replace({x}, {sql_string(_NON_DIGIT_RE)}, '')"


def title_case(x: str) -> str:
    """``str.title()``: a cased character after a non-cased one (or at the
    start) is title-cased, every other cased character lower-cased.

    Text of ASCII letters and spaces only is exactly ``initcap``. Otherwise
    every non-cased character gets a space appended, so ``initcap`` (which
    starts words after spaces) starts a word exactly where Python does; the
    added spaces are then removed again.
    """
    non_cased = "([^" + _CASED + "])"
    marked = f"regexp_replace({x}, {sql_string(non_cased)}, '$1 ')"
    general = f"regexp_replace(initcap({marked}), {sql_string(non_cased + ' ')}, '$1')"
    return (f"CASE WHEN {x} RLIKE {sql_string('^[A-Za-z ]*' + chr(92) + 'z')} "
            f"THEN initcap({x}) ELSE {general} END")


def first_word(x: str) -> str:
    """``s.split()[0]``, NULL when there is no word."""
    return f"nullif(regexp_extract({strip(x)}, {_NOT_WS_RUN}, 1), '')"
