"""Column expressions: vectors, units, keys, casts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Periods of the time key and the unit that date_trunc takes for each.
PERIODS = {"Y": "year", "Q": "quarter", "M": "month", "W": "week", "D": "day", "h": "hour", "min": "minute", "s": "second", "ms": "millisecond", "us": "microsecond"}
#: 1900-01-01 in epoch seconds.
EPOCH_1900 = -2208988800
KM_PER_DEGREE = 111.0


def seconds_of(t: Column) -> Column:
    """Epoch seconds of a timestamp with or without time zone (UTC)."""
    return F.unix_seconds(t.cast("timestamp"))


def micros_of(t: Column) -> Column:
    return F.unix_micros(t.cast("timestamp"))


def speed(u: Column, v: Column) -> Column:
    return F.sqrt(u * u + v * v)


def direction_toward(u: Column, v: Column) -> Column:
    """Degrees clockwise from north to which a vector points."""
    return F.pmod(F.degrees(F.atan2(u, v)), F.lit(360.0))


def direction_from(u: Column, v: Column) -> Column:
    return F.pmod(F.degrees(F.atan2(-u, -v)), F.lit(360.0))


def components_from(speed_: Column, direction: Column) -> tuple[Column, Column]:
    """(u, v) of a speed and the direction that it comes from."""
    return -speed_ * F.sin(F.radians(direction)), -speed_ * F.cos(F.radians(direction))


def celsius(value: Column, units: Column) -> Column:
    return F.when(F.lower(units).isin("kelvin", "k"), value - 273.15).otherwise(value)


def ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b)


def clipped_fraction(a: Column, b: Column) -> Column:
    return F.least(F.greatest(a / b, F.lit(0.0)), F.lit(1.0))


def relative_correction(raw: Column, corrected: Column) -> Column:
    return (raw - corrected) / raw


def wave_energy(height: Column, period: Column | None = None) -> Column:
    return height * height if period is None else height * height * period


def planar_km(lat: Column, lon: Column, lat0: float, lon0: float) -> Column:
    """Distance on the plane that touches at lat0, in km."""
    dlat, dlon = lat - F.lit(lat0), (lon - F.lit(lon0)) * F.cos(F.radians(F.lit(lat0)))
    return F.sqrt(dlat * dlat + dlon * dlon) * KM_PER_DEGREE


def degree_distance(lat: Column, lon: Column, lat0: float, lon0: float) -> Column:
    return F.sqrt((lat - lat0) * (lat - lat0) + (lon - lon0) * (lon - lon0))


def duration_hours(start: Column, end: Column) -> Column:
    return (F.unix_timestamp(end) - F.unix_timestamp(start)) / 3600.0


def difference_with_error(c: Column, a: Column, sd_c: Column, sd_a: Column, n: Column) -> tuple[Column, Column]:
    """(c - a, its propagated standard deviation), where there are observations."""
    return F.when(n > 0, c - a), F.when(n > 0, F.sqrt(sd_c * sd_c + sd_a * sd_a))


def season(t: Column) -> Column:
    m = F.month(t)
    return F.when(m.isin(12, 1, 2), "DJF").when(m.isin(3, 4, 5), "MAM").when(m.isin(6, 7, 8), "JJA").when(m.isin(9, 10, 11), "SON")


def period_key(t: Column, period: str) -> Column:
    """Epoch seconds of the start of the period that holds t."""
    if period not in PERIODS:
        raise ValueError(f"period {period!r} is none of {sorted(PERIODS)}")
    return seconds_of(F.date_trunc(PERIODS[period], t))


def cell_centre(coordinate: Column, delta: float) -> Column:
    """Centre of the grid cell of a coordinate: quotients are truncated towards zero."""
    return (coordinate / F.lit(float(delta))).cast("long") * F.lit(float(delta))


def _double_hex(x: Column) -> Column:
    """The 8 bytes of a double, little end first, in hex; for whole multiples that are exact.

    Built from sign, exponent and fraction, which stay in Column expressions.
    """
    a = F.abs(x)
    power = F.floor(F.log2(F.when(a > 0, a).otherwise(1.0))).cast("long")
    # log2 may be off at powers of two; put right by comparison.
    power = F.when(F.pow(F.lit(2.0), power + 1) <= a, power + 1).when(F.pow(F.lit(2.0), power) > a, power - 1).otherwise(power)
    fraction = F.round((a / F.pow(F.lit(2.0), power) - 1) * F.lit(float(1 << 52))).cast("long")
    bits = F.when(a == 0, F.lit(0)).otherwise((power + 1023) * F.lit(1 << 52) + fraction)
    body = F.lpad(F.hex(bits), 16, "0")
    high = F.when(x < 0, F.lpad(F.hex(F.conv(F.substring(body, 1, 2), 16, 10).cast("int") + 128), 2, "0")).otherwise(F.substring(body, 1, 2))
    big = F.concat(high, F.substring(body, 3, 14))
    return F.concat(*[F.substring(big, 15 - 2 * k, 2) for k in range(8)])


def square_wkb(lon: Column, lat: Column, delta: float) -> Column:
    """Hex WKB of the square around a cell centre, `delta` to each side: one ring of five points from the lower left."""
    x0, x1, y0, y1 = _double_hex(lon - delta), _double_hex(lon + delta), _double_hex(lat - delta), _double_hex(lat + delta)
    ring = [(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)]
    return F.concat(F.lit("01" + "03000000" + "01000000" + "05000000"), *[c for point in ring for c in point])


#: Smallest literal types' fill values.
FILLS = {"string": "", "boolean": False}


def scalar_cast(value: Column, type_: str, fill=None) -> Column:
    """A string as a typed value: blank or failing values become the fill; numbers keep a leading number ("16m" is 16)."""
    fill = FILLS.get(type_, -9999) if fill is None else fill
    text = F.trim(value.cast("string"))
    text = F.when(text != "", text)
    default = F.lit(fill).cast(type_)
    if type_ == "string":
        return F.coalesce(text, default)
    if type_ == "boolean":
        return F.coalesce(text.try_cast("boolean"), default)
    leading = F.regexp_extract(text, r"^[-+]?(?:[0-9]*\.[0-9]+|[0-9]+)", 0)
    number = F.coalesce(text.try_cast("double"), F.when(leading != "", leading).try_cast("double"))
    return F.coalesce(number.try_cast(type_), default)


def utf8_trimmed(value: Column) -> Column:
    return F.trim(F.decode(value, "UTF-8"))


def date_with_hour(day: Column, hour: Column) -> Column:
    """Timestamp of a date and an hour text; the date alone where the hour doesn't parse."""
    return F.coalesce(F.try_to_timestamp(F.concat_ws(" ", day, F.coalesce(hour, F.lit("00:00:00")))), F.try_to_timestamp(day))


def valid_date(text: Column) -> Column:
    """Midnight-UTC timestamp of a year, year-month or date text, missing fields taken from 1900-01-01; else NULL."""
    padded = F.when(text.rlike(r"^\d{4}$"), F.concat(text, F.lit("-01-01"))).when(text.rlike(r"^\d{4}-\d{1,2}$"), F.concat(text, F.lit("-01"))).otherwise(text)
    return F.try_to_timestamp(padded)


def rose_sector(direction: Column, sectors: int = 16) -> Column:
    """1-based sector; the last is closed at 360."""
    return F.least(F.floor(direction / (360.0 / sectors)) + 1, F.lit(sectors)).cast("int")


def right_closed_bin(value: Column, width: float, low: float, high: float) -> Column:
    """Centre of the (low + k*width, low + (k+1)*width] bin of a value, NULL outside."""
    k = F.ceil((value - low) / width) - 1
    return F.when((value > low) & (value <= high), F.lit(low) + (k + 0.5) * width)
