"""Column functions: genotype text, allele picks, INFO fields. All are built-in expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


# Genotype text


def alt_indices(gt: Column | str) -> Column:
    """Numbers of the ALT alleles in a call, as text, in order; none for 0/0, null for null."""
    return F.regexp_extract_all(_c(gt), F.lit(r"([1-9][0-9]*)"), 1)


def is_missing_gt(gt: Column | str) -> Column:
    """Some allele of the call is missing."""
    return F.contains(_c(gt), F.lit("."))


def is_carrier_call(gt: Column | str) -> Column:
    """A fully called genotype with an ALT allele: ./1 is not one."""
    return F.coalesce(_c(gt).rlike("[1-9]") & ~is_missing_gt(gt), F.lit(False))


def is_multiallelic_het(gt: Column | str) -> Column:
    """Two or more ALT alleles that differ, such as 1/2."""
    alleles = alt_indices(gt)
    return (F.size(alleles) > 1) & (F.size(F.array_distinct(alleles)) > 1)


def carrier(gt: Column | str, allele_num: Column | str) -> Column:
    """1 or 0: whether the call holds the allele; null if some allele is missing, 0 for a null call."""
    return F.when(is_missing_gt(gt), None).when(F.array_contains(alt_indices(gt), _c(allele_num).cast("string")), 1).otherwise(0)


def alleles_in_gt(gt: Column | str) -> Column:
    """ALT numbers joined by commas; empty text if there are none."""
    return F.array_join(alt_indices(gt), ",")


def gt_text(alleles: Column | str, phased: Column | str) -> Column:
    """Text of a call from allele numbers: -1 or null is '.', '|' if phased, '.' if there are none."""
    shown = F.transform(_c(alleles), lambda a: F.when(a.isNull() | (a < 0), ".").otherwise(a.cast("string")))
    return F.coalesce(F.nullif(_joined(shown, phased), F.lit("")), F.lit("."))


def _joined(shown: Column, phased: Column | str) -> Column:
    return F.when(F.coalesce(_c(phased), F.lit(False)), F.array_join(shown, "|")).otherwise(F.array_join(shown, "/"))


def format_text(values: Column | str) -> Column:
    """Numbers of a FORMAT field joined by commas, '.' where one or all are missing."""
    return F.coalesce(F.nullif(F.array_join(F.transform(_c(values), lambda v: v.cast("string")), ",", "."), F.lit("")), F.lit("."))


def first_text(values: Column | str) -> Column:
    """First number of a FORMAT field as text, '.' where it is missing."""
    return F.coalesce(F.get(_c(values), F.lit(0)).cast("string"), F.lit("."))


# Picks by allele


def item(text: Column | str, number: Column, lenient: bool) -> Column:
    """The number-th (from 1) of comma-separated items; out of range: null if lenient, else an error."""
    parts = F.split(_c(text), ",")
    return F.try_element_at(parts, number) if lenient else F.element_at(parts, number)


def alt_of_call(alt: Column | str, allele_num: Column | str, lenient: bool = False) -> Column:
    return item(alt, _c(allele_num), lenient)


def depth_of(ad: Column | str, number: Column, lenient: bool = False) -> Column:
    """An allele's depth as text: item number + 1 of AD (0: REF); null where AD is null or '.'."""
    ad = _c(ad)
    return F.when(ad.isNull() | (ad == "."), None).otherwise(item(ad, number + 1, lenient))


def allele_pick(allele_num: Column | str) -> Column:
    """Item number for an annotation's ALLELE_NUM text: not a number is the first; 0 and -1 are the last and so on."""
    n = F.coalesce(_c(allele_num).try_cast("int"), F.lit(1))
    return F.when(n >= 1, n).otherwise(n - 1)


# INFO text


def info_value(info: Column | str, key: str, anchored: bool = False) -> Column:
    """Text after KEY= up to the next ';', null if there is none.

    Not anchored, AC= is also found within MLEAC= where that comes first.
    """
    start = r"(?:^|;)" if anchored else ""
    return F.nullif(F.regexp_extract(_c(info), f"{start}{re.escape(key)}=([^;]+)", 1), F.lit(""))


def info_of_allele(info: Column | str, key: str, allele_num: Column | str, anchored: bool = False) -> Column:
    """The allele's item of an INFO field, 'NA' where field or item is missing."""
    return F.coalesce(item(info_value(info, key, anchored), allele_pick(allele_num), lenient=True), F.lit("NA"))


def without_tail(info: Column | str, key: str = "CSQ") -> Column:
    """INFO up to ';KEY'; a KEY that comes first stays."""
    return F.regexp_replace(_c(info), f";{re.escape(key)}.*", "")


def without_key(info: Column | str, key: str) -> Column:
    """INFO without KEY and its value, wherever it stands; '.' if nothing is left."""
    rest = F.regexp_replace(_c(info), f"^{re.escape(key)}(=[^;]*)?(;|$)|;{re.escape(key)}(=[^;]*)?(?=;|$)", "")
    return F.when(rest == "", ".").otherwise(rest)


def ceil_div(n: Column | str, size: int) -> Column:
    return F.ceil(_c(n) / F.lit(size)).cast("long")
