"""Text functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Markers, meter words and their core counts.
CUT_MARKERS = ("-646", "-preview")
SHARED_CORE_METER = "sharedcore"
SHARED_CORE_COUNT = 0.1666
CORE_SUFFIX = "core"
NAME_SEPARATOR = "__"
SIZE_FIELD = "servicetype"


def right_part(c: Column, size: int) -> Column:
    """The last ``size`` characters of longer text; shorter text unchanged."""
    return F.when(F.length(c) > size, F.right(c, F.lit(size))).otherwise(c)


def cut_at_marker(c: Column, markers: tuple[str, ...] = CUT_MARKERS) -> Column:
    """Text before the first of the markers."""
    return F.regexp_replace(c, "(?s)(" + "|".join(markers) + ").*$", "")


def quoted_field(c: Column, field: str = SIZE_FIELD) -> Column:
    """The quoted value of a field inside JSON-like text, whatever the case of its name."""
    found = F.regexp_extract(c, f'(?i)"?{field}"?\\s*:\\s*"([^"]*)"', 1)
    return F.nullif(found, F.lit(""))


def number_field(c: Column, field: str) -> Column:
    """The whole-number value of a field inside JSON-like text."""
    return F.regexp_extract(c, f'"{field}"\\s*:\\s*(-?\\d+)', 1).try_cast("int")


def after_separator(c: Column, separator: str = NAME_SEPARATOR) -> Column:
    """Text after the first separator, the whole text without one, null if that is empty."""
    at = F.instr(c, separator)
    return F.nullif(
        F.when(at > 0, F.substring(c, at + len(separator), F.length(c))).otherwise(c), F.lit("")
    )


def first_filled(*columns: Column) -> Column:
    """The first value that is neither null nor empty."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns])


def core_count(meter: Column) -> Column:
    """Cores named by a meter: a shared core, ``<n>core``, else null."""
    m = F.lower(meter)
    return F.when(m == SHARED_CORE_METER, F.lit(SHARED_CORE_COUNT)).when(
        m.contains(CORE_SUFFIX), F.regexp_extract(m, rf"(\d+)\s*{CORE_SUFFIX}", 1).try_cast("double")
    )


def core_meter(cores: Column) -> Column:
    """``<n>core`` for a positive whole core count, null for none."""
    return F.when(F.coalesce(cores, F.lit(0)) != 0, F.concat(cores.cast("bigint").cast("string"), F.lit(CORE_SUFFIX)))


def lower_md5(c: Column) -> Column:
    return F.md5(F.lower(c))


def contains_text(c: Column, word: str) -> Column:
    """Case-blind containment; null text does not contain anything."""
    return F.coalesce(F.lower(c).contains(word.lower()), F.lit(False))


def classify_text(c: Column, rules: list[tuple[str, str]], otherwise: str) -> Column:
    """The label of the first word the lower-cased text contains."""
    lowered = F.lower(c)
    chain = None
    for word, label in rules:
        hit = lowered.contains(word)
        chain = F.when(hit, label) if chain is None else chain.when(hit, label)
    return chain.otherwise(otherwise)


def like_any_case(c: Column, pattern: str) -> Column:
    """LIKE on lower-cased text; write ``\\_`` for an underscore."""
    return F.coalesce(F.lower(c).like(pattern), F.lit(False))


def strip_prefix(c: Column, prefix: str) -> Column:
    return F.regexp_replace(c, f"^{prefix}", "")


def flag_text(c: Column) -> Column:
    """1 for the text ``true`` or ``1``, else 0."""
    return F.coalesce(F.lower(F.trim(c)).isin("true", "1").cast("int"), F.lit(0))


def override_id(c: Column, names: dict[str, str], otherwise: Column) -> Column:
    """Canonical names of a few known ids, else the natural one."""
    chain = None
    for known, name in names.items():
        hit = F.lower(c.cast("string")) == known.lower()
        chain = F.when(hit, name) if chain is None else chain.when(hit, name)
    return otherwise if chain is None else chain.otherwise(otherwise)
