"""Date parsing and formatting expressions.

All are Column expressions: they run inside whole-stage codegen, per row,
with no Python in the task.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What the fallback reads when the strict format fails
# (SURVEY §2.12 item 5), after an ISO date or timestamp: the shape of the
# text (# four digits, 9 other digits, D a number above 12 next to another
# number, a a word of up to three letters, @ a longer one) and its format.
# Where day and month could be swapped the month comes first, except in
# dotted dates.
FALLBACK_FORMATS = {
    "#-9-9": "yyyy-M-d",
    "#/9/9": "yyyy/M/d",
    "#.9.9": "yyyy.M.d",
    "##": "yyyyMMdd",
    "##a#9": "yyyyMMdd'T'HHmmss",
    "9/9/#": "M/d/yyyy",
    "9/D/#": "M/d/yyyy",
    "D/9/#": "d/M/yyyy",
    "9-9-#": "M-d-yyyy",
    "9-D-#": "M-d-yyyy",
    "D-9-#": "d-M-yyyy",
    "9.9.#": "d.M.yyyy",
    "D.9.#": "d.M.yyyy",
    "9 a #": "d MMM yyyy",
    "9 @ #": "d MMMM yyyy",
    "9-a-#": "d-MMM-yyyy",
    "a 9, #": "MMM d, yyyy",
    "@ 9, #": "MMMM d, yyyy",
    "a 9 #": "MMM d yyyy",
    "@ 9 #": "MMMM d yyyy",
    "#/9/9 9:9": "yyyy/M/d H:m",
    "#/9/9 9:9:9": "yyyy/M/d H:m:s",
    "9/9/# 9:9": "M/d/yyyy H:m",
    "9/D/# 9:9": "M/d/yyyy H:m",
    "D/9/# 9:9": "d/M/yyyy H:m",
    "9/9/# 9:9:9": "M/d/yyyy H:m:s",
    "9/D/# 9:9:9": "M/d/yyyy H:m:s",
    "D/9/# 9:9:9": "d/M/yyyy H:m:s",
    "#-9-9 9:9 a": "yyyy-M-d h:m a",
    "9/9/# 9:9 a": "M/d/yyyy h:m a",
    "9/D/# 9:9 a": "M/d/yyyy h:m a",
}
# The same for files whose dates have the day first, or the month first,
# where that is another format.
DAY_FIRST_FORMATS = {
    "9/9/#": "d/M/yyyy",
    "9-9-#": "d-M-yyyy",
    "9/9/# 9:9": "d/M/yyyy H:m",
    "9/9/# 9:9:9": "d/M/yyyy H:m:s",
    "9/9/# 9:9 a": "d/M/yyyy h:m a",
    "D/9/# 9:9 a": "d/M/yyyy h:m a",
}
MONTH_FIRST_FORMATS = {"9.9.#": "M.d.yyyy", "9.D.#": "M.d.yyyy"}
DAY_FIRST, MONTH_FIRST = "day first", "month first"
# The texts whose shapes begin with D/9/# and 9/D/#.
SHOWS_DAY_FIRST = r"^(?:1[3-9]|[2-9]\d)([/.-])\d{1,2}\1(?:\d{4}|#)"
SHOWS_MONTH_FIRST = r"^\d{1,2}([/.-])(?:1[3-9]|[2-9]\d)\1(?:\d{4}|#)"

# A day's name before a date says nothing more.
WEEKDAY = r"^(?i:mon|tues?|wed(?:nes)?|thu(?:rs)?|fri|sat(?:ur)?|sun)(?:day)?\.?,?\s+(?=[a-zA-Z0-9])"
# Years of two digits, after two numbers: from 69 on of the 20th century.
SHORT_YEAR_19, SHORT_YEAR_20 = r"^(\d{1,2}/\d{1,2}/)(69|[7-9]\d)$", r"^(\d{1,2}/\d{1,2}/)(\d\d)$"

# Guard for the ISO step: a bare cast accepts '12:00' (today at noon) and
# '2025' (1 January), so require a full date followed by a time part.
ISO_TIMESTAMP_GUARD = r"^\s*\d{4}-\d{1,2}-\d{1,2}[ T]"
# An ISO timestamp that ends in an offset is an instant; it is read as UTC
# (the offset is applied, not dropped).
OFFSET_GUARD = r"[ T][\d:.]+\s*([zZ]|UTC|GMT|[+-]\d{1,2}(:?\d{2})?)$"

# Strftime directives and the Spark pattern letters that
# read the same text (single letters accept one or two digits, as pandas
# does for %m and %d).
STRFTIME_TO_SPARK = {
    "%Y": "yyyy", "%y": "yy", "%m": "M", "%d": "d", "%H": "H", "%M": "m",
    "%S": "s", "%b": "MMM", "%B": "MMMM", "%f": "SSSSSS", "%%": "%",
}


def spark_pattern(fmt: str) -> str:
    """Translate a strftime format (as the reference takes it) to a Spark
    datetime pattern; Spark patterns pass through unchanged."""
    if "%" not in fmt:
        return fmt
    out, i = [], 0
    while i < len(fmt):
        token = fmt[i:i + 2]
        if token in STRFTIME_TO_SPARK:
            out.append(STRFTIME_TO_SPARK[token])
            i += 2
        elif fmt[i].isalpha():
            out.append(f"'{fmt[i]}'")
            i += 1
        else:
            out.append(fmt[i])
            i += 1
    return "".join(out)


# A plain ISO date; text of this shape is read by the date cast, which is
# much cheaper than a pattern-based parse and accepts the same values as
# the pattern yyyy-M-d.
ISO_DATE_SHAPE = r"^\d{4}-\d{1,2}-\d{1,2}$"


def _one_format(c: Column, fmt: str) -> Column:
    if fmt == "ISO":
        t = F.trim(c)
        instant = F.to_utc_timestamp(t.try_cast("timestamp"), F.current_timezone()).cast("timestamp_ntz")
        return F.when(c.rlike(ISO_TIMESTAMP_GUARD),
                      F.when(t.rlike(OFFSET_GUARD), instant).otherwise(t.try_cast("timestamp_ntz")))
    pattern = spark_pattern(fmt)
    if pattern == "yyyy-M-d":
        return F.when(c.rlike(ISO_DATE_SHAPE), c.try_cast("date").cast("timestamp_ntz"))
    return F.try_to_timestamp(c, F.lit(pattern)).cast("timestamp_ntz")


def parse_strict(c: Column, fmt: str | None) -> Column:
    """Parse with one format; NULL where it fails. ``None`` means no
    strict format (C2), so only the fallback list applies."""
    if fmt is None:
        return F.lit(None).cast("timestamp_ntz")
    return _one_format(c, fmt)


def _plain(c: Column) -> Column:
    """The text without what does not matter: blanks around it, a day's
    name before it, a short form of the year."""
    text = F.regexp_replace(F.trim(c), WEEKDAY, "")
    return F.regexp_replace(F.regexp_replace(text, SHORT_YEAR_19, "$119$2"), SHORT_YEAR_20, "$120$2")


# The steps from a text to its shape.
_SHAPE_STEPS = (
    (r"\d{4}", "#"),
    ("[a-zA-Z]{4,}", "@"),
    ("[a-zA-Z]+", "a"),
    (r"^(?:1[3-9]|[2-9]\d)(?=([/.-])\d{1,2}\1)", "D"),
    (r"^(\d{1,2}([/.-]))(?:1[3-9]|[2-9]\d)(?=\2)", "$1D"),
    (r"\d+", "9"),
)


def _shape(text: Column) -> Column:
    for pattern, mark in _SHAPE_STEPS:
        text = F.regexp_replace(text, pattern, mark)
    return text


def _lookup(formats: dict[str, str], shape: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in formats.items() for x in pair]), shape)


def parse_fallback(c: Column, order: Column | None = None) -> Column:
    """C3 fallback: the format of the text's shape, per row. Surrounding
    blanks are ignored here (the strict format keeps them). Looking the
    format up by shape instead of trying formats in turn keeps the generated
    code small and a hopeless text cheap. ``order`` (DAY_FIRST, MONTH_FIRST or
    NULL) says which number of a date comes first where the text does not
    show it; without it the fixed list does."""
    trimmed, plain = F.trim(c), _plain(c)
    shape = _shape(plain)
    pattern = _lookup(FALLBACK_FORMATS, shape)
    if order is not None:
        pattern = F.coalesce(F.when(order == DAY_FIRST, _lookup(DAY_FIRST_FORMATS, shape)).when(
            order == MONTH_FIRST, _lookup(MONTH_FIRST_FORMATS, shape)), pattern)
    return F.coalesce(_one_format(trimmed, "yyyy-M-d"), _one_format(trimmed, "ISO"),
                      F.try_to_timestamp(plain, pattern).cast("timestamp_ntz"))


def order_evidence(c: Column) -> Column:
    """DAY_FIRST or MONTH_FIRST where a text shows it (one number is above
    12), else NULL."""
    text = _plain(c)
    return F.when(text.rlike(SHOWS_DAY_FIRST), F.lit(DAY_FIRST)).when(text.rlike(SHOWS_MONTH_FIRST), F.lit(MONTH_FIRST))


def parse_date(c: Column, fmt: str | None = "%Y-%m-%d", order: Column | None = None) -> Column:
    """Strict format first, fallback (on the trimmed text) for the rows it
    rejects; ``coalesce`` stops at the first hit, so a row the strict
    format parses is parsed once."""
    if fmt is None:
        return parse_fallback(c, order)
    return F.coalesce(parse_strict(c, fmt), parse_fallback(c, order))


def ensure_timestamp(c: Column, is_timestamp: bool) -> Column:
    """Leave timestamps alone, coerce anything else (NULL on failure)."""
    if is_timestamp:
        return c
    return parse_fallback(c.cast("string"))


def iso_date(c: Column) -> Column:
    """``YYYY-MM-DD`` text of a timestamp or date."""
    return F.date_format(c, "yyyy-MM-dd")


def day(c: Column) -> Column:
    """timestamp → date."""
    return F.to_date(c)


def normalize_date_str(s: str) -> str:
    """``YYYY-MM-DD`` → ``YYYYMMDD``."""
    return s.replace("-", "") if "-" in s else s
