"""Text: trimming, titles, tokens, byte lengths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The title rule. Group 1 is the title up to an optional ": episode", group 2 the
# first year of "(2019)", "(2016–2022)" or "(2019– )".
TITLE_RULE = r"^(.*?)(?::\s*.*)?\s*\((\d{4})(?:–\d{4})?(?:–\s*)?\)"
# The same rule for callers that want "Title: Subtitle" kept whole.
TITLE_RULE_WITH_SUBTITLE = r"^(.*?)\s*\((\d{4})(?:–\d{4})?(?:–\s*)?\)"

# d: only \n ends a line; U: Unicode digits and blanks.
_FLAGS = "(?dU)"


def strip(text: Column) -> Column:
    """Remove blanks, tabs and line ends on both sides (SQL `trim` removes blanks only)."""
    return F.regexp_replace(text, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def title_parts(text: Column, keep_subtitle: bool = False) -> tuple[Column, Column]:
    """(title, year) of a scraped title; (input, null) where the rule does not match."""
    rule = _FLAGS + (TITLE_RULE_WITH_SUBTITLE if keep_subtitle else TITLE_RULE)
    year = F.regexp_extract(text, rule, 2)
    title = F.when(year != "", strip(F.regexp_extract(text, rule, 1))).otherwise(text)
    return title, F.when(year != "", year)


def words(text: Column) -> Column:
    """Lower-cased pieces between single blanks; null text counts as empty.

    Like the ML Tokenizer, keeps empty pieces between two blanks and drops trailing ones.
    """
    lowered = F.lower(F.coalesce(text, F.lit("")))
    pieces = F.split(F.regexp_replace(lowered, r"\s+$", ""), r"\s", -1)
    return F.when(lowered.rlike(r"^\s+$"), F.array().cast("array<string>")).otherwise(pieces)


def byte_length(text: Column) -> Column:
    """UTF-8 bytes of the text, 0 for null."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint")
