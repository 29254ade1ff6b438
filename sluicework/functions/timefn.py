"""Timestamp, epoch and date expressions.

Every function maps columns (or column names) to one column.  Wall-clock
results are ``TIMESTAMP_NTZ`` and never depend on the session or host zone;
unparseable input gives null instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UTC = "UTC"
IST = "Asia/Kolkata"
# The form document stores write: ``2024-06-20T02:35:38.000Z``.
ISO_MILLIS = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\.\d{3}Z$"

# Strptime directives with an exact Java pattern counterpart.
STRPTIME_TO_JAVA = {
    "Y": "yyyy",
    "m": "MM",
    "d": "dd",
    "H": "HH",
    "M": "mm",
    "S": "ss",
    "f": "SSSSSS",
}

# Epoch values of at least this magnitude are read as milliseconds: as seconds
# they would lie beyond the year 5138, as milliseconds they start in 1973.
MILLIS_FROM = 100_000_000_000

# Some 8,000 years within the ends of a 64-bit count.
MICROS_WITHIN = 9_223_372_036_854_775_807 - 2**58


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _wall_clock(micros: Column) -> Column:
    """UTC wall clock of an epoch microsecond count."""
    return F.timestamp_add("MICROSECOND", micros, F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'"))


def _scaled(value: Column, micros: int) -> Column:
    """Microseconds of an epoch count; null beyond what any zone can shift."""
    scaled = F.try_multiply(value, F.lit(micros).cast("bigint"))
    return F.when(scaled.between(-MICROS_WITHIN, MICROS_WITHIN), scaled)


def epoch_to_timestamp(epoch_seconds: Column | str) -> Column:
    """Instant of an epoch second count."""
    return F.timestamp_micros(_scaled(as_column(epoch_seconds).try_cast("bigint"), 1_000_000))


def convert_timezone(timestamp: Column | str, from_tz: str = UTC, to_tz: str = IST) -> Column:
    """Wall clock in ``to_tz`` for a wall clock in ``from_tz``."""
    wall_clock = as_column(timestamp).try_cast("timestamp_ntz")
    return F.convert_timezone(F.lit(from_tz), F.lit(to_tz), wall_clock)


def utc_to_ist(timestamp: Column | str) -> Column:
    return convert_timezone(timestamp, UTC, IST)


def epoch_to_ist(epoch_seconds: Column | str) -> Column:
    seconds = as_column(epoch_seconds).try_cast("bigint")
    return utc_to_ist(_wall_clock(_scaled(seconds, 1_000_000)))


def any_epoch_to_ist(epoch: Column | str, keep_millis: bool = False) -> Column:
    """As :func:`epoch_to_ist`, also accepting 12- and 13-digit milliseconds.

    Milliseconds are cut to whole seconds unless ``keep_millis`` is set.
    """
    value = as_column(epoch).try_cast("bigint")
    from_millis = _scaled(value, 1_000)
    if not keep_millis:
        from_millis = from_millis - F.pmod(from_millis, F.lit(1_000_000))
    micros = F.when((value >= MILLIS_FROM) | (value <= -MILLIS_FROM), from_millis).otherwise(_scaled(value, 1_000_000))
    return utc_to_ist(_wall_clock(micros))


def java_pattern(strptime_format: str) -> str:
    """Java date pattern of a strptime format; unknown directives raise."""
    pattern, literal = [], []

    def close_literal() -> None:
        if literal:
            pattern.append("'" + "".join(literal).replace("'", "''") + "'")
            literal.clear()

    characters = iter(strptime_format)
    for character in characters:
        if character != "%":
            literal.append(character)
            continue
        directive = next(characters, "")
        if directive == "%":
            literal.append("%")
        elif directive in STRPTIME_TO_JAVA:
            close_literal()
            pattern.append(STRPTIME_TO_JAVA[directive])
        else:
            raise ValueError(f"unsupported strptime directive %{directive} in {strptime_format!r}")
    close_literal()
    return "".join(pattern)


def _parse(text: Column | str, pattern: str) -> Column:
    # Reading the text at an explicit offset keeps the session zone out of it.
    instant = F.try_to_timestamp(
        F.concat(as_column(text).cast("string"), F.lit(" +00:00")), F.lit(pattern + " XXX")
    )
    return _wall_clock(F.unix_micros(instant))


def string_to_timestamp(text: Column | str, strptime_format: str) -> Column:
    """Wall clock written in ``text``, read by a strptime format."""
    return _parse(text, java_pattern(strptime_format))


def string_to_ist(text: Column | str, strptime_format: str | None = None) -> Column:
    """IST wall clock of a UTC string, by default like ``2024-06-20T02:35:38.000Z``."""
    if strptime_format is not None:
        return utc_to_ist(_parse(text, java_pattern(strptime_format)))
    # A cast of the checked form costs a fraction of parsing it by a pattern.
    value = as_column(text).cast("string")
    return utc_to_ist(F.when(value.rlike(ISO_MILLIS), F.substring(value, 1, 23)))


def _moment(value: Column | str) -> Column:
    return as_column(value).try_cast("timestamp")


def year_frac(from_dt: Column | str, to_dt: Column | str) -> Column:
    """Years between two dates, counting a month as a twelfth."""
    return F.months_between(_moment(to_dt), _moment(from_dt)) / 12


def age_in_years(birth: Column | str, as_of: Column | None = None) -> Column:
    """Whole years since ``birth`` on ``as_of`` (today if not given)."""
    return year_frac(birth, F.current_date() if as_of is None else as_of).cast("int")


def year_text(date: Column | str) -> Column:
    return F.year(as_column(date).try_cast("date")).cast("string")
