"""String functions with Python's exact meaning, as built-in Column
expressions (JVM side, no UDF; the regex ones compile once per task)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ticketloom.fixed_values import INST_CLOSE

# Python's str.isspace(): Unicode White_Space plus the four separators
# U+001C..U+001F; U+200B is not a space.
_STRIP = r"(?U)^[\s\x{1c}-\x{1f}]+|[\s\x{1c}-\x{1f}]+$"
# A word run as Python's \w sees it (letters, numbers, underscore).
WORD_RUN = r"[\p{L}\p{N}_]+"
# A token of the length budget: a word run or any single other visible char.
TOKEN = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_ \t\n\r]"
# A whole word run; the group is empty unless the run has ASCII lower-case letters alone.
_ASCII_RUN = r"([a-z]++)(?![\p{L}\p{N}_])|[\p{L}\p{N}_]++"
_JSON_BLOCK = r"(?s)\{.*\}"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c) -> Column:
    """``str.strip()``: all Unicode whitespace at both ends."""
    return F.regexp_replace(_col(c), _STRIP, "")


def ascii_words(c) -> Column:
    """``re.findall(r'\\b[a-z]+\\b', text.lower())`` as an array.

    A match of ``\\b[a-z]+\\b`` is exactly a maximal word run that consists of
    ASCII lower-case letters only; Java's ``\\b`` differs from Python's on
    combining marks, so the pattern takes whole word runs, and those with
    anything else leave an empty group behind, which is removed.
    """
    return F.array_remove(F.regexp_extract_all(F.lower(_col(c)), F.lit(_ASCII_RUN), 1), "")


def tokens(c) -> Column:
    """Approximate tokenizer used for length budgets."""
    return F.regexp_extract_all(_col(c), F.lit(TOKEN), 0)


def reply_tail(c) -> Column:
    """``s.split('[/INST]')[-1].strip()``."""
    return py_strip(F.substring_index(_col(c), INST_CLOSE, -1))


def json_block(c) -> Column:
    """``re.search(r'\\{.*\\}', s, re.DOTALL)``: first '{' to last '}'; null
    when there is no match."""
    m = F.regexp_extract(_col(c), _JSON_BLOCK, 0)
    return F.when(m != "", m)


def contains_ci(c, needle: str) -> Column:
    """Case-insensitive substring test; null -> false."""
    return F.coalesce(F.lower(_col(c)).contains(needle.lower()), F.lit(False))
