"""Format guards, display formats and fingerprints."""

from pyspark.sql import Column, functions as F

from .money import dbl, rnd


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


UUID_PATTERN = "^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"
ENTITY_CODE_PATTERN = r"^[A-Za-z0-9_\-]{1,50}$"


def is_uuid(c) -> Column:
    return F.coalesce(_c(c).rlike(UUID_PATTERN), F.lit(False))


def is_entity_code(c) -> Column:
    return F.coalesce(_c(c).rlike(ENTITY_CODE_PATTERN), F.lit(False))


def fmt_millions(c, unit="HUF") -> Column:
    return F.format_string(f"%.1fM {unit}", rnd(dbl(c) / 1e6, 1))


def fmt_percent(c) -> Column:
    return F.format_string("%.1f%%", rnd(c, 1))


def fmt_multiple(c) -> Column:
    return F.format_string("%.2fx", rnd(c, 2))


def fmt_days(c) -> Column:
    return F.format_string("%.0f days", rnd(c, 0))


def shown(c, formatted) -> Column:
    """The formatted text, or null for a missing value."""
    return F.when(_c(c).isNotNull(), formatted)


def is_material(pct, threshold=5.0) -> Column:
    return F.coalesce(F.abs(_c(pct)) >= threshold, F.lit(False))


def fingerprint(*cols) -> Column:
    """SHA-256 over the parts joined by a bar; a missing part counts as empty text."""
    return F.sha2(F.concat_ws("|", *[F.coalesce(_c(c).cast("string"), F.lit("")) for c in cols]), 256)


def parse_comma_decimal(c) -> Column:
    """Text such as `1 234,50` to an amount; unreadable text becomes null."""
    return F.regexp_replace(F.regexp_replace(_c(c), r"\s", ""), ",", ".").try_cast("decimal(18,2)")
