"""Column functions for messages: redaction, error classes, credential lines, sizes and durations.

All are built-in expressions whose cost is linear in the text, so they stay in generated code.
"""

from __future__ import annotations

import functools
import operator
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Error classes, matched anywhere in the message regardless of case.
FATAL_PATTERNS = (
    "authentication", "permission denied", "access denied", "invalid credentials",
    "unauthorized", "forbidden", "incompatible schema", "incompatible type",
)
RETRYABLE_PATTERNS = (
    "connection refused", "connection reset", "timeout", "deadline exceeded", "temporary failure",
    "too many requests", "rate limit", "quota exceeded", "service unavailable", "server busy",
    "i/o timeout", "broken pipe", "eof",
)
# Settings that must refer to an environment variable, and the masks.
CREDENTIAL_FIELDS = ("password", "slack_webhook", "credentials_file")
REDACTED = "[REDACTED]"
# What counts as a space around a setting.
SPACES = (
    " \t\n\r\x0b\x0c\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
MASK = "***"

KIB = 1024
MIB = 1024 * 1024
#: From here on every double is whole.
WHOLE = 2**53


def redact_urls(message: Column) -> Column:
    """Replace the first token holding ``://`` by a marker; tokens end at a space or a quote."""
    at = F.instr(message, "://")
    before = F.substring(message, F.lit(1), at - 1)
    after = F.substring(message, at + 3, F.length(message))
    # Finding the token's edges by searching for one delimiter avoids a backtracking pattern, which
    # would be quadratic on long unbroken tokens.
    from_right = F.instr(F.reverse(F.translate(before, "\"'", "  ")), " ")
    kept = F.when(from_right > 0, F.substring(before, F.lit(1), F.length(before) - from_right + 1)).otherwise("")
    from_left = F.instr(F.translate(after, "\"'", "  "), " ")
    rest = F.when(from_left > 0, F.substring(after, from_left, F.length(after))).otherwise("")
    return F.when(at > 0, F.concat(kept, F.lit(REDACTED), rest)).otherwise(message)


def _any_of(text: Column, patterns: tuple[str, ...]) -> Column:
    return functools.reduce(operator.or_, (F.contains(text, F.lit(p)) for p in patterns))


def classify_error(message: Column) -> Column:
    """``fatal``, ``retryable`` or ``other``; a fatal pattern outranks a retryable one."""
    # The lower-case text occurs often in the first condition, so generated code makes it once and reuses it. Plain
    # searches beat one pattern of alternatives on long texts.
    lowered = F.lower(message)
    return (
        F.when(_any_of(lowered, FATAL_PATTERNS), "fatal")
        .when(_any_of(lowered, RETRYABLE_PATTERNS), "retryable")
        .when(message.isNotNull(), "other")
    )


def is_fatal_message(message: str) -> bool:
    """The fatal class for one message on the driver, where the retry wrapper needs it."""
    text = message.lower()
    return any(p in text for p in FATAL_PATTERNS)


def credential_field(line: Column) -> Column:
    """The credential setting a line fills with a literal value, or NULL."""
    trimmed = F.trim(line, F.lit(SPACES))
    finding = F.lit(None).cast("string")
    for field in reversed(CREDENTIAL_FIELDS):
        start = len(field) + 1
        value = F.trim(F.substring(trimmed, F.lit(start + 1), F.length(trimmed)), F.lit(SPACES))
        hit = F.startswith(trimmed, F.lit(field + ":")) & (F.length(value) > 0) & ~F.contains(value, F.lit("${"))
        finding = F.when(hit, field).otherwise(finding)
    return finding


def may_hold_credentials(text: Column) -> Column:
    """Cheap test on the whole text that lets most texts skip the line split."""
    return _any_of(text, tuple(f + ":" for f in CREDENTIAL_FIELDS))


def mask() -> Column:
    """A constant mask that tells nothing about the value, not even its length."""
    return F.lit(MASK)


def format_bytes(size: Column) -> Column:
    """Size, an integer or a decimal without places, as ``12 B``, ``3.4 KB`` or ``5.6 MB`` in steps of 1024, exact halves to even."""
    def scaled(step: int, unit: str) -> Column:
        # Dividing by a power of 2 and taking tenths of what is left are exact. Spark's own rounding goes by the shortest
        # decimal text of a double, in which large sizes look like halves that they are not.
        value = size.cast("double") / step
        high = F.floor(value / WHOLE)  # above 0 only for sizes beyond bigint, whose digits no bigint holds
        low = value - high * float(WHOLE)
        tenths = F.floor(low) * 10 + F.rint((low - F.floor(low)) * 10).cast("bigint")
        digits = (high.cast("decimal(19,0)") * F.lit(Decimal(WHOLE)) + F.floor(low)).cast("string")
        return F.when(high > 0, F.concat(digits, F.lit(f".0 {unit}"))).otherwise(F.format_string(f"%d.%d {unit}", _div(tenths, 10), tenths % 10))

    return (
        F.when(size >= MIB, scaled(MIB, "MB"))
        .when(size >= KIB, scaled(KIB, "KB"))
        .otherwise(F.concat(size.cast("string"), F.lit(" B")))
    )


def _div(number: Column, unit: int) -> Column:
    return F.call_function("div", number, F.lit(unit))


def _with_fraction(whole: Column, part: Column, digits: int) -> Column:
    padded = F.rtrim(F.lpad(part.cast("string"), digits, "0"), F.lit("0"))
    return F.concat(whole.cast("string"), F.when(part > 0, F.concat(F.lit("."), padded)).otherwise(""))


def format_duration(micros: Column) -> Column:
    """Microseconds as ``1h2m3.5s``: leading zero units are left out, below a second ``ms`` or ``µs``."""
    seconds = _div(micros, 1_000_000)
    hours, minutes = _div(seconds, 3600), _div(seconds % 3600, 60)
    return (
        F.when(micros == 0, "0s")
        .when(micros < 1_000, F.concat(micros.cast("string"), F.lit("µs")))
        .when(micros < 1_000_000, F.concat(_with_fraction(_div(micros, 1_000), micros % 1_000, 3), F.lit("ms")))
        .otherwise(F.concat(
            F.when(hours > 0, F.concat(hours.cast("string"), F.lit("h"))).otherwise(""),
            F.when(seconds >= 60, F.concat(minutes.cast("string"), F.lit("m"))).otherwise(""),
            _with_fraction(seconds % 60, micros % 1_000_000, 6), F.lit("s"),
        ))
    )
