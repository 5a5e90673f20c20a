"""Label mappings between spellings, codes and class names."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from veristream import fixed_values as fv
from veristream.functions.text import strip


def _lookup(key: Column, mapping: dict) -> Column:
    pairs = [F.lit(x) for pair in mapping.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), key)


def to_code(c: Column) -> Column:
    """Any spelling to 0..3; unknown and null give 0."""
    mapping = {name.lower(): code for name, code in fv.LABEL_CODES.items()}
    mapping["hoax"] = mapping["hoaks"]
    return F.coalesce(_lookup(F.lower(strip(c)), mapping), F.lit(0))


def feedback_code(c: Column) -> Column:
    """Case-sensitive; alias 'Hoax'; unknown gives null (row to be dropped)."""
    return _lookup(c, {**fv.LABEL_CODES, "Hoax": fv.LABEL_CODES["Hoaks"]})


def from_code(c: Column) -> Column:
    return _lookup(c, {code: name for name, code in fv.LABEL_CODES.items()})


def normalize(c: Column) -> Column:
    """Strip, and spell 'Hoax' as 'Hoaks'."""
    s = strip(c)
    return F.when(s == "Hoax", F.lit("Hoaks")).otherwise(s)


def in_domain(c: Column) -> Column:
    return c.isin(fv.LABELS)


def is_risk(c: Column) -> Column:
    return c.isin(fv.RISK_LABELS)


def from_sms(c: Column) -> Column:
    """0 Netral, 1 Penipuan, 2 Netral, anything else null."""
    return _lookup(c, {0: "Netral", 1: "Penipuan", 2: "Netral"})


def from_flag(c: Column) -> Column:
    """Text or number whose whole part is 1 means Hoaks, all else Valid."""
    whole = c.cast("string").try_cast("double").try_cast("int")
    return F.when(whole == 1, F.lit("Hoaks")).otherwise(F.lit("Valid"))
