"""Text and array column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted forms of contact fields.
EMAIL_FORM = r"^[A-Za-z0-9+_.-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"
PHONE_FORM = r"^[0-9]{10,15}$"


def sentence_case(text: Column) -> Column:
    """Trimmed, lower case, first letter upper case."""
    clean = F.lower(F.trim(text))
    return F.concat(F.upper(F.left(clean, F.lit(1))), F.substr(clean, F.lit(2)))


def field(text: Column, separator: str, index: int) -> Column:
    """The ``index``-th field (from 0), null when there are fewer."""
    return F.get(F.split(text, separator), F.lit(index))


def is_email(text: Column) -> Column:
    return text.rlike(EMAIL_FORM)


def is_phone(text: Column) -> Column:
    return text.rlike(PHONE_FORM)


def has_ignoring_case(values: Column, wanted: str) -> Column:
    return F.exists(values, lambda v: F.lower(v) == wanted.lower())


def mirrored(values: Column) -> Column:
    return F.concat(values, F.reverse(values))


def pick(values: Column, index: Column) -> Column:
    """1-based element, null out of range."""
    return F.try_element_at(values, index)


def map_value(table: dict[str, str], key: Column, default: str) -> Column:
    pairs = [F.lit(x) for item in table.items() for x in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), key), F.lit(default))


def payload_sample(raw: Column, size: int = 200) -> Column:
    """The first ``size`` base64 characters of raw bytes, for a report; ``size`` is a multiple of 4.
    The bytes themselves are kept whole elsewhere."""
    return F.translate(F.base64(F.substring(raw, 1, size // 4 * 3)), "\r\n", "")
