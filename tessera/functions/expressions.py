"""Column -> Column builders (X1-X15). All are built-in Spark expressions: they stay in the JVM,
inside whole-stage codegen, and never fail a job on dirty text (``try_*`` forms throughout,
since ANSI mode turns a bad cast into an error)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---- fixed values: part-of-day bands (inclusive hour ranges) and their labels ----------------
PART_OF_DAY_BANDS = [
    ("Morning", 5, 11),
    ("Afternoon", 12, 16),
    ("Evening", 17, 20),
]
PART_OF_DAY_REST = "Night"  # every other hour: 21..23 and 0..4
# ---- fixed values: the whitespace set of Python's str.split() (code points)
# 0x09-0x0d, 0x1c-0x20, 0x85, 0xa0, 0x1680, 0x2000-0x200a, 0x2028, 0x2029, 0x202f, 0x205f, 0x3000
# = Unicode White_Space plus the separators 0x1c-0x1f
WHITESPACE_CHARS = "".join(chr(c) for lo, hi in [(0x09, 0x0D), (0x1C, 0x20), (0x85, 0x85),
                                                 (0xA0, 0xA0), (0x1680, 0x1680),
                                                 (0x2000, 0x200A), (0x2028, 0x2029),
                                                 (0x202F, 0x202F), (0x205F, 0x205F),
                                                 (0x3000, 0x3000)]
                           for c in range(lo, hi + 1))
# ---- fixed values: text timestamp pattern and money pattern ------------------------------------
TEXT_TIMESTAMP_PATTERN = "yyyy MMM dd hh:mm:ss a"
MONEY_PATTERN = r"^\$([\d,]+)$"
# ------------------------------------------------------------------------------------------------


def _epoch_ntz() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def strip(text: str | Column) -> Column:
    """Remove leading and trailing whitespace (X3), the same set as Python's ``str.strip()``
    (Spark's plain ``trim`` removes only the blank character). A character-set trim: no regex."""
    return F.btrim(_c(text), F.lit(WHITESPACE_CHARS))


def explode_tokens(df: DataFrame, text: str | Column, alias: str = "word") -> DataFrame:
    """One row per whitespace-separated token of ``text`` (X1 + P11).

    Whitespace is the set Python's ``str.split()`` uses (ASCII blanks plus the Unicode spaces). It is
    mapped to the blank character first, so that the split needs no regular expression; the empty
    pieces between neighbouring blanks go in a plain filter, in generated code."""
    blanks = F.translate(_c(text), WHITESPACE_CHARS, " " * len(WHITESPACE_CHARS))
    words = df.select(F.explode(F.split(blanks, " ")).alias(alias))
    return words.where(F.col(alias) != F.lit(""))


def money_to_double(text: str | Column) -> Column:
    """``'$52,806'`` -> 52806.0; surrounding blanks are ignored; anything else -> null."""
    digits = F.regexp_extract(strip(text), MONEY_PATTERN, 1)
    return F.regexp_replace(digits, ",", "").try_cast("double")


def parse_timestamp(text: str | Column, pattern: str = TEXT_TIMESTAMP_PATTERN,
                    ntz: bool = True) -> Column:
    """Text -> timestamp with a zone-less pattern; unparsable text -> null.

    ``ntz`` returns the wall-clock value exactly as written, whatever the session time zone.
    The text is parsed once, as UTC (an explicit ``+0000`` offset is appended), and the instant's
    microseconds since the epoch are laid onto the zone-less epoch. Casting a session-zone
    timestamp instead would move wall-clock times that fall in a daylight-saving gap, and the
    NTZ parser itself fails the job on bad text in ANSI mode.
    """
    if not ntz:
        return F.try_to_timestamp(_c(text), F.lit(pattern))
    as_utc = F.try_to_timestamp(F.concat(_c(text), F.lit(" +0000")), F.lit(pattern + " Z"))
    return F.timestamp_add("MICROSECOND", F.unix_micros(as_utc), _epoch_ntz())


def clock_text(ts: str | Column) -> Column:
    """A timestamp's time of day as ``HHMM`` text (``'0045'``), by arithmetic (no formatter)."""
    t = _c(ts)
    return F.lpad((F.hour(t) * 100 + F.minute(t)).cast("string"), 4, "0")


def hhmm_to_hour(text: str | Column) -> Column:
    """``'1350'`` -> 13, ``'0045'`` -> 0, ``'1345.0'`` -> 13; blank or junk -> null."""
    t = strip(text)
    as_int = F.coalesce(t.try_cast("int"), t.try_cast("double").try_cast("int"))
    return (as_int / F.lit(100)).cast("int")


def part_of_day(hour: str | Column, unknown: str = "drop") -> Column:
    """Hour -> ``Morning``/``Afternoon``/``Evening``/``Night``.

    A null hour gives null with ``unknown="drop"`` or ``"null"`` (filter it with ``isNotNull``
    to drop), or the rest label with ``unknown="Night"``.
    """
    h = _c(hour)
    expr = None
    for label, lo, hi in PART_OF_DAY_BANDS:
        cond = (h >= lo) & (h <= hi)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    if unknown == PART_OF_DAY_REST:
        return expr.otherwise(PART_OF_DAY_REST)
    return expr.when(h.isNotNull(), PART_OF_DAY_REST)


def rounded(x: str | Column, scale: int = 2) -> Column:
    """Spark's ``round``: half up (away from zero) on the decimal text of the value (X11)."""
    return F.round(_c(x), scale)


def percent_of(part: str | Column, whole: str | Column, scale: int = 2) -> Column:
    """``100 * part / whole`` rounded half up to ``scale`` places, exactly.

    For non-negative integer counts: integer arithmetic on the exact fraction, so no binary
    rounding error can move a tie. A zero or null denominator gives null."""
    p, w = _c(part).cast("long"), _c(whole).cast("long")
    k = 10 ** scale
    num = p * F.lit(200 * k) + w
    den = w * F.lit(2)
    # integer quotient: num - num % den is an exact multiple of den, so the double division
    # lands within an ulp of the integer and round() recovers it
    quotient = F.round((num - num % den) / den)
    return F.when(w > 0, quotient.cast("double") / F.lit(float(k)))


def safe_long(text: str | Column) -> Column:
    """Integer text -> bigint; null or junk -> 0."""
    return F.coalesce(strip(_c(text).cast("string")).try_cast("long"), F.lit(0).cast("long"))


def sorted_values(arr: str | Column) -> Column:
    """X14."""
    return F.sort_array(_c(arr))


def fixed_text(fmt: str, *cols: str | Column) -> Column:
    """``format_string`` with printf patterns such as ``'%s,%.2f'``."""
    return F.format_string(fmt, *[_c(c) for c in cols])


def times(x: str | Column, factor: int | float, widen: bool = True) -> Column:
    """Multiply by a constant (P4). ``widen`` casts an integral input to bigint first, so that
    ``int * 14`` cannot overflow (ANSI mode fails on overflow instead of wrapping)."""
    return (_c(x).cast("long") if widen else _c(x)) * F.lit(factor)
