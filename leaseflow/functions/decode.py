"""Scalar decoding of change-record values, as built-in column expressions.

Nothing here depends on the session time zone and nothing leaves the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The business wall clock and the text form of its times.
WALL_ZONE = "Asia/Shanghai"
WALL_OFFSET_MILLIS = 8 * 3600 * 1000
WALL_PATTERN = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}\.\d{6}$"

_NTZ_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def decode_decimal(encoded: Column | str, scale: int = 2, precision: int = 19) -> Column:
    """base64 of a signed big-endian integer -> DECIMAL(precision, scale).

    NULL for text that is not base64, is empty or does not fit the target, whatever
    sign bytes it is padded with. The value is put together from a signed and an
    unsigned 8-byte half of its sign-extended 16-byte form. Validity is decided inside
    the padding, so that shared parts of the expression are computed once per row.
    """
    given = F.hex(F.try_to_binary(_col(encoded), F.lit("base64")))
    digits = F.when(F.length(given) <= 32, given).otherwise(_shortest(given))
    pad = (F.when(~F.length(digits).between(2, 32), F.lit(None).cast("string"))
           .when(F.substring(digits, 1, 1) >= "8", F.lit("F")).otherwise(F.lit("0")))
    wide = F.lpad(digits, F.lit(32), pad)
    high = F.conv(F.substring(wide, 1, 16), 16, -10).cast("bigint")
    low = F.conv(F.substring(wide, 17, 16), 16, 10).cast("decimal(20,0)")
    unscaled = F.try_add(
        F.try_multiply(high.cast("decimal(19,0)"), F.lit(str(2**64)).cast("decimal(20,0)")), low)
    unit = F.lit("0." + "0" * (scale - 1) + "1" if scale else "1")
    value = F.try_multiply(unscaled, unit.cast(f"decimal({scale + 1},{scale})"))
    return value.try_cast(f"decimal({precision},{scale})")


def encode_decimal(amount: Column | str, scale: int = 2) -> Column:
    """DECIMAL -> base64 of its shortest signed big-endian unscaled integer."""
    amount = _col(amount)
    unscaled = (amount * F.lit(10**scale)).cast("decimal(20,0)")
    negative = unscaled < 0
    # Eight bytes as an unsigned number, and a sign byte before them.
    low = F.when(negative, unscaled + F.lit(str(2**64)).cast("decimal(20,0)")).otherwise(unscaled)
    digits = F.lpad(F.conv(low.cast("decimal(20,0)").cast("string"), 10, 16), 16, "0")
    full = F.concat(F.when(negative, "FF").otherwise("00"), digits)
    return F.base64(F.unhex(_shortest(full)))


def _shortest(digits: Column) -> Column:
    """Hex digits without the bytes that only repeat the sign."""
    return F.regexp_replace(
        F.regexp_replace(digits, "^(00)+(?=[0-7])", ""), "^(FF)+(?=[89A-F])", "")


def micros_to_wall(micros: Column | str) -> Column:
    """epoch microseconds -> business wall time (TIMESTAMP_NTZ)."""
    # convert_timezone looks its zones up by name for every row, this once.
    return instant_as_wall(F.from_utc_timestamp(F.timestamp_micros(_col(micros)), WALL_ZONE))


def wall_to_micros(wall: Column | str) -> Column:
    """business wall time -> epoch microseconds (regional zone rules)."""
    return F.unix_micros(F.to_utc_timestamp(wall_as_instant(wall), WALL_ZONE))


def naive_micros(wall: Column | str) -> Column:
    """Microseconds since 1970-01-01 00:00 on the same wall clock."""
    elapsed = (_col(wall) - F.expr(_NTZ_EPOCH)).cast("interval second")
    return (elapsed.cast("decimal(18,6)") * 1_000_000).cast("bigint")


def wall_as_instant(wall: Column | str) -> Column:
    """TIMESTAMP whose UTC reading is the wall time: what watermarks need."""
    return F.timestamp_micros(naive_micros(wall))


def instant_as_wall(instant: Column | str) -> Column:
    """Inverse of :func:`wall_as_instant`."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(_col(instant)), F.expr(_NTZ_EPOCH))


def wall_text(wall: Column | str) -> Column:
    """Wall time with six fractional digits, the form facts carry as JSON."""
    text = _col(wall).cast("string")  # shows as many fractional digits as needed
    return F.concat(F.substring(text, 1, 19), F.lit("."),
                    F.rpad(F.substring(text, 21, 6), 6, "0"))


def parse_wall(text: Column | str) -> Column:
    """Exact-pattern text -> wall time; anything else -> NULL."""
    text = _col(text)
    return F.when(text.rlike(WALL_PATTERN), text.try_cast("timestamp_ntz"))


def wall_to_millis(text: Column | str) -> Column:
    """Exact-pattern wall text -> epoch milliseconds at the fixed +8 offset."""
    micros = naive_micros(parse_wall(text))
    return F.floor(micros / F.lit(1000)).cast("bigint") - WALL_OFFSET_MILLIS


def millis_to_wall(millis: Column | str) -> Column:
    return micros_to_wall(_col(millis) * 1000)


def window_time(millis: Column | str) -> Column:
    """epoch ms -> wall time text to the second (window bounds)."""
    return F.substring(millis_to_wall(millis).cast("string"), 1, 19)


def window_date(millis: Column | str) -> Column:
    """epoch ms -> wall date (window day)."""
    return F.to_date(millis_to_wall(millis))
