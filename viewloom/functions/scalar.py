"""Scalar vocabulary of calculation views as Column helpers.

Everything stays in Catalyst. Source text is often blank or holds sentinels, so conversions use the
``try_`` forms: they give NULL where an ANSI cast would stop the job.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed values of the source system.
BLANK_DATE = "00000000"
DATE_FORMAT = "yyyyMMdd"
TIMESTAMP_FORMAT = "yyyyMMddHHmmss"
BLANK_IDENTIFIERS = ("", "0", "000000000", "-99999999")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def now() -> Column:
    return F.current_timestamp()


def is_null(c) -> Column:
    return _col(c).isNull()


def if_(condition: Column, then, otherwise) -> Column:
    return F.when(condition, then).otherwise(otherwise)


def case_(c, *pairs, default=None) -> Column:
    """``case(x, a, b, c, d, default)``: NULL matches NULL, as in DECODE."""
    chain = F
    for match, result in zip(pairs[::2], pairs[1::2]):
        chain = chain.when(_col(c).eqNullSafe(match), result)
    return chain.otherwise(default)


def midstr(c, start: int, length: int) -> Column:
    return F.substring(_col(c), start, length)


def leftstr(c, length: int) -> Column:
    return F.left(_col(c), F.lit(length))


def rightstr(c, length: int) -> Column:
    return F.right(_col(c), F.lit(length))


def match(c, glob: str) -> Column:
    """Whole-string match of a pattern in which only ``*`` is special."""
    pieces = ["\\Q" + part + "\\E" if part else "" for part in glob.split("*")]
    return _col(c).rlike("(?s)^" + ".*".join(pieces) + "$")


def sap_date(c) -> Column:
    return F.try_to_date(_col(c), DATE_FORMAT)


def sap_timestamp(c) -> Column:
    """14 digits, optionally followed by fraction digits (18 characters in mutation ids)."""
    text = _col(c)
    whole = F.left(text, F.lit(14))
    fraction = F.rpad(F.substring(text, 15, 6), 6, "0")
    # to_timestamp does not parse a fraction glued to the seconds, so a dot is put between
    moment = F.try_to_timestamp(F.concat(whole, F.lit("."), fraction), F.lit("yyyyMMddHHmmss.SSSSSS"))
    return moment.cast("timestamp_ntz")


def days_between(first, second) -> Column:
    return F.datediff(_col(second), _col(first))


def string(c) -> Column:
    return _col(c).cast("string")


def in_(c, *values) -> Column:
    return _col(c).isin(*values)


def not_in(c, *values) -> Column:
    return ~_col(c).isin(*values)


def to_int(c) -> Column:
    return _col(c).try_cast("int")


def comma_decimal(c, precision: int = 17, scale: int = 2) -> Column:
    return F.replace(_col(c), F.lit(","), F.lit(".")).try_cast(f"decimal({precision},{scale})")


def decfloat(c, precision: int = 3, scale: int = 0) -> Column:
    """Decimal of the declared element type; NULL when the value does not fit."""
    return _col(c).try_cast(f"decimal({precision},{scale})")


def round0(c) -> Column:
    return F.round(_col(c), 0)


def safe_div(numerator, denominator) -> Column:
    d = _col(denominator)
    return F.when(d != 0, _col(numerator) / d).otherwise(0)


def cat(*cs) -> Column:
    return F.concat(*[_col(c) for c in cs])


def year8(c) -> Column:
    return F.year(sap_date(c))


def hash_id(c) -> Column:
    """Upper-case SHA-256 of an identifier; blank and sentinel identifiers stay blank, NULL stays NULL."""
    text = _col(c)
    return F.when(text.isin(*BLANK_IDENTIFIERS), "").otherwise(F.upper(F.sha2(text, 256)))


def age(year, birth) -> Column:
    """Calendar age in ``year``; impossible ages (below 0, above 999) are unknown."""
    years = _col(year) - year8(birth)
    return F.when(years.between(0, 999), years)


def part(c, pattern: str, index: int) -> Column:
    """``split(c)[index]``, NULL when there are too few parts. ``pattern`` is a regular expression."""
    return F.get(F.split(_col(c), pattern), F.lit(index))


def suffix_after(c, marker: str) -> Column:
    """Text between the first and the second ``marker``, or to the end; NULL without marker."""
    return part(c, "\\Q" + marker + "\\E", 1)


def strip_precision(c) -> Column:
    return F.regexp_replace(_col(c), r"\(.*\)", "")


def lower_unquoted(c) -> Column:
    """Lower-case everything outside single quotes."""
    pieces = F.split(_col(c), "'")
    lowered = F.transform(pieces, lambda piece, i: F.when(i % 2 == 0, F.lower(piece)).otherwise(piece))
    return F.array_join(lowered, "'")


def type_match(target_type, source_type) -> Column:
    """Three-valued: NULL when a side is missing; STRING also stands for NVARCHAR."""
    target, source = _col(target_type), _col(source_type)
    same = (target == source) | ((target == "STRING") & (source == "NVARCHAR"))
    return F.when(target.isNotNull() & source.isNotNull(), same)


def filled_flag(c) -> Column:
    return F.when(_col(c) == "", "").otherwise("X")


def typed(c, declared: str) -> Column:
    """Value of a calculated column by its declared type."""
    if declared == "DATE":
        return sap_date(c)
    if declared == "TIMESTAMP":
        return F.try_to_timestamp(_col(c), F.lit(TIMESTAMP_FORMAT)).cast("timestamp_ntz")
    return _col(c)
