"""Column expressions: calendar, rounding, coordinates, radiation and humidity. All stay inside the JVM."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

ANNUAL, WINTER, SPRING, SUMMER, FALL = "Annual", "Winter", "Spring", "Summer", "Fall"
SEASONS = (ANNUAL, WINTER, SPRING, SUMMER, FALL)
ZERO_CELSIUS = 273.15
STEFAN_BOLTZMANN = 5.67e-8
#: Cosine of the zenith angle from which the sun counts as shining.
SUNLIT = 0.10
#: 1900-01-01T00:00Z in seconds since 1970.
EPOCH_1900 = -2_208_988_800


def season(day: Column) -> Column:
    """The season of a date's calendar month; December belongs to the winter of its own year."""
    month = F.month(day)
    return F.when(month.isin(12, 1, 2), WINTER).when(month.isin(3, 4, 5), SPRING).when(month.isin(6, 7, 8), SUMMER).when(month.isNotNull(), FALL)


def with_annual(day: Column) -> Column:
    """An array of the two seasons that a day counts in."""
    return F.array(F.lit(ANNUAL), season(day))


def leap(year: Column) -> Column:
    return (year % 4 == 0) & ((year % 100 != 0) | (year % 400 == 0))


def expected_days(year: Column, name: Column) -> Column:
    extra = F.when(leap(year), 1).otherwise(0)
    return F.when(name == ANNUAL, 365 + extra).when(name == WINTER, 90 + extra).when(name.isin(SPRING, SUMMER), F.lit(92)).when(name == FALL, F.lit(91))


def is_finite(x: Column) -> Column:
    return F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))


def null_outside(x: Column, low: float, high: float) -> Column:
    """x where it is a number from low to high, else null; NaN and infinity lie above every bound."""
    return F.when(x.between(low, high), x)


def rint_to(x: Column, per_unit: float) -> Column:
    """Half-to-even rounding to 1 / per_unit."""
    return F.rint(x * per_unit) / per_unit


def round_half_up(x: Column, places: int) -> Column:
    """Half-away-from-zero rounding of the decimal value, as numeric columns do it."""
    return F.round(x.cast("decimal(24,12)"), places)


def snap(x: Column, cell: float = 0.25) -> Column:
    return F.rint(x / cell) * cell


def cell_id(x: Column, cell: float = 0.25) -> Column:
    return F.rint(x / cell).cast("int")


def wrap360(lng: Column) -> Column:
    return F.pmod(lng, F.lit(360.0))


def to_180(lng: Column) -> Column:
    return F.when(lng > 180.0, lng - 360.0).otherwise(lng)


def hour_to_ts(hour: Column) -> Column:
    """Hours since 1900 as a timestamp."""
    return F.timestamp_seconds(F.lit(EPOCH_1900) + hour.cast("long") * 3600)


def ts_to_hour(ts: Column) -> Column:
    return F.floor((F.unix_timestamp(ts) - EPOCH_1900) / 3600).cast("int")


def year_hours(year: int) -> tuple[int, int]:
    """First and last hour since 1900 of a year."""
    days = lambda y: 365 * (y - 1900) + (y - 1901) // 4 - (y - 1901) // 100 + (y - 1601) // 400
    return 24 * days(year), 24 * days(year + 1) - 1


def first_hour(year: Column) -> Column:
    """First hour since 1900 of a year."""
    return (F.datediff(F.make_date(year, F.lit(1), F.lit(1)), F.lit("1900-01-01").cast("date")) * 24).cast("int")


def date_hour(day: Column) -> Column:
    """A date's first hour since 1900."""
    return (F.datediff(day, F.lit("1900-01-01").cast("date")) * 24).cast("int")


def hour_year(hour: Column) -> Column:
    """The year (UTC) that an hour since 1900 lies in."""
    return F.year(F.date_add(F.lit("1900-01-01").cast("date"), F.floor(hour / 24).cast("int")))


def time_bucket(hour: Column, start: Column | int, size: int) -> Column:
    return F.floor((hour - start) / size).cast("int")


def flux(joules: Column) -> Column:
    return joules / 3600.0


def celsius(kelvin: Column) -> Column:
    return kelvin - ZERO_CELSIUS


def kelvin(c: Column) -> Column:
    return c + ZERO_CELSIUS


def wind(u: Column, v: Column) -> Column:
    return F.sqrt(u * u + v * v)


def relative_humidity(t: Column, dew: Column) -> Column:
    """Per cent from temperatures in Celsius by the Magnus form, kept in 0 to 100."""
    magnus = lambda x: F.exp(17.625 * x / (243.04 + x))
    return F.least(F.greatest(100.0 * magnus(dew) / magnus(t), F.lit(0.0)), F.lit(100.0))


def svp(t_kelvin: Column) -> Column:
    """Saturation vapour pressure in hPa (Murray)."""
    t = celsius(t_kelvin)
    return 6.11 * F.pow(F.lit(10.0), 7.45 * t / (235.0 + t))


def _harmonics(angle: Column, constant: float, terms: list[tuple[float, float]]) -> Column:
    total = F.lit(constant)
    for k, (cosine, sine) in enumerate(terms, 1):
        total = total + cosine * F.cos(k * angle) + sine * F.sin(k * angle)
    return total


def cossza(lat: Column, lng: Column, ts: Column) -> Column:
    """Cosine of the solar zenith angle, 0 at night: Fourier series of declination and equation of time."""
    hour = F.hour(ts) + F.minute(ts) / 60.0
    angle = 2.0 * math.pi / 365.0 * (F.dayofyear(ts) - 1.0 + (hour - 12.0) / 24.0)
    # Fourier coefficients (cosine, sine) of the solar declination and the equation of time.
    declination = _harmonics(angle, 0.006918, [(-0.399912, 0.070257), (-0.006758, 0.000907), (-0.002697, 0.00148)])
    minutes = 229.18 * _harmonics(angle, 0.000075, [(0.001868, -0.032077), (-0.014615, -0.040849)])
    hour_angle = F.radians((hour * 60.0 + minutes + 4.0 * lng) / 4.0 - 180.0)
    phi = F.radians(lat)
    value = F.sin(phi) * F.sin(declination) + F.cos(phi) * F.cos(declination) * F.cos(hour_angle)
    return F.least(F.greatest(value, F.lit(0.0)), F.lit(1.0))


def dsrp(direct: Column, cos_zenith: Column) -> Column:
    """Direct radiation on a plane across the beam; none while the sun is low."""
    return F.when(cos_zenith >= SUNLIT, F.greatest(F.try_divide(direct, cos_zenith), F.lit(0.0))).otherwise(F.lit(0.0))


def mrt(ssrd: Column, ssr: Column, beam: Column, strd: Column, fdir: Column, strr: Column, cos_zenith: Column) -> Column:
    """Mean radiant temperature in Kelvin of a standing person from six fluxes."""
    elevation = F.degrees(F.asin(cos_zenith))
    projected = 0.308 * F.cos(F.radians(elevation * (0.998 - elevation * elevation / 50000.0)))
    diffuse, reflected, upward = ssrd - fdir, ssrd - ssr, strd - strr
    absorbed = 0.5 * strd + 0.5 * upward + 0.7 / 0.97 * (0.5 * diffuse + 0.5 * reflected + projected * beam)
    return F.pow(absorbed / STEFAN_BOLTZMANN, F.lit(0.25))


def model_predict(m: Column, t: Column) -> Column:
    """Value of a fitted trend (struct of degree, coef2, coef1, coef0, reference_year) at t."""
    x = t - m["reference_year"]
    return F.when(m["degree"] == 2, m["coef2"] * x * x + m["coef1"] * x + m["coef0"]).otherwise(m["coef1"] * x + m["coef0"])


def model_slope(m: Column, t: Column) -> Column:
    return F.when(m["degree"] == 2, 2.0 * m["coef2"] * (t - m["reference_year"]) + m["coef1"]).otherwise(m["coef1"])


def model_acceleration(m: Column) -> Column:
    return F.when(m["degree"] == 2, 2.0 * m["coef2"]).otherwise(F.lit(0.0))
