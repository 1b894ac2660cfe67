"""Text cleaning, rule-based bucketing and encoding repair."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Java's Unicode \s leaves out the four separators U+001C-U+001F, and trim()
# only knows U+0020, so every whitespace rule goes through these two patterns.
_SPACE_RUN = r"(?U)[\s\x1c-\x1f]+"
_SPACE_ENDS = r"(?U)\A[\s\x1c-\x1f]+|[\s\x1c-\x1f]+\z"


def strip(c: Column) -> Column:
    return F.regexp_replace(c, _SPACE_ENDS, "")


def strip_upper(c: Column) -> Column:
    return F.upper(strip(c))


def clean_text(c: Column) -> Column:
    """Trimmed, upper-cased, whitespace runs collapsed; null becomes ''."""
    return F.coalesce(F.upper(F.trim(F.regexp_replace(c, _SPACE_RUN, " "))), F.lit(""))


def is_blank(c: Column) -> Column:
    """True for empty or all-whitespace text; null is not blank."""
    return F.coalesce(strip(c.cast("string")) == "", F.lit(False))


def map_by_rules(c: Column, rules: Iterable[tuple[str, str, str]], default: str) -> Column:
    """First matching ``(kind, pattern, bucket)`` rule wins; kind is equals or contains."""
    value = F.upper(F.regexp_replace(F.coalesce(c, F.lit("")), _SPACE_RUN, ""))
    chain = F
    for kind, pattern, bucket in rules:
        if kind == "equals":
            matches = value == pattern
        elif kind == "contains":
            matches = value.contains(pattern)
        else:
            raise ValueError(f"Unknown rule kind: {kind!r}")
        chain = chain.when(matches, bucket)
    return chain.otherwise(default) if chain is not F else F.lit(default)


def _cp1252_pairs() -> tuple[str, str]:
    """The printable characters windows-1252 puts on bytes 80-9F, and those bytes."""
    shown, raw = [], []
    for byte in range(0x80, 0xA0):
        try:
            shown.append(bytes([byte]).decode("cp1252"))
            raw.append(chr(byte))
        except UnicodeDecodeError:
            continue
    return "".join(shown), "".join(raw)


_CP1252_SHOWN, _CP1252_RAW = _cp1252_pairs()


# A multi-byte UTF-8 character shows as one of the first followed by one of the
# second; text without such a pair cannot have been misread.
_MISREAD_PAIR = f"[\u00c2-\u00f4][\u0080-\u00bf{_CP1252_SHOWN}]"


def repair_mojibake(c: Column) -> Column:
    """Undo UTF-8 text that was read as windows-1252; anything else is unchanged.

    encode() raises on characters outside its charset, so the rlike guard has
    to come first; CASE WHEN evaluates a branch only for rows that reach it. Its
    anchors are absolute: $ would also match before a last line separator.
    """
    as_bytes = F.translate(c, _CP1252_SHOWN, _CP1252_RAW)
    decoded = F.try_validate_utf8(F.encode(as_bytes, "ISO-8859-1").cast("string"))
    repaired = F.when(as_bytes.rlike(r"\A[\x00-\xff]*\z"), decoded)
    return F.coalesce(F.when(c.rlike(_MISREAD_PAIR), repaired), c)
