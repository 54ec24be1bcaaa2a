"""Column expressions shared by every layer. All of them stay inside the JVM."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
SUM_MONEY = "decimal(28,2)"
WEIGHTED = "decimal(24,4)"
PAY = "decimal(30,8)"

YEAR_FIRST = r"^\d{4}-\d{1,2}-\d{1,2}$"
YEAR_SLASH = r"^(\d{4})/(\d{1,2})/(\d{1,2})$"
DAY_FIRST = r"^(\d{1,2})([/-])(\d{1,2})\2(\d{4})$"


def require_exact(spark: SparkSession) -> None:
    """Sums of cents must fail when they overflow, which they do under ANSI rules only."""
    if spark.conf.get("spark.sql.ansi.enabled") != "true":
        raise ValueError("set spark.sql.ansi.enabled to true: without it, sums that overflow wrap around silently")


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Double quotient; null when the denominator is null or zero."""
    num = F.col(numerator) if isinstance(numerator, str) else numerator
    den = F.col(denominator) if isinstance(denominator, str) else denominator
    return F.try_divide(num.cast("double"), den.cast("double"))


def pct(numerator, denominator, digits: int = 1) -> Column:
    """Rounded percentage of two totals."""
    num = F.col(numerator) if isinstance(numerator, str) else numerator
    return F.round(ratio(F.lit(100.0) * num.cast("double"), denominator), digits)


def usd(amount: Column | str, digits: int = 0) -> Column:
    """Exact decimal rounding of a money total, shown as a double."""
    col = F.col(amount) if isinstance(amount, str) else amount
    return F.round(col, digits).cast("double")


def total(amount: Column | str, when: Column | None = None, scale: int = 2, kind: str = SUM_MONEY) -> Column:
    """Exact sum of line amounts, optionally of the lines meeting a condition (0 where none does).

    Lines are added up as whole cents in a long, several times cheaper than wide decimals; a sum
    that would not fit raises instead of wrapping around.
    """
    col = F.col(amount) if isinstance(amount, str) else amount
    units = (col * F.lit(10 ** scale)).cast("long")
    added = F.sum(units if when is None else F.when(when, units).otherwise(F.lit(0)))
    return (added.cast("decimal(20,0)") * F.lit(Decimal(1).scaleb(-scale))).cast(kind)


def count_if(condition: Column) -> Column:
    return F.count_if(F.coalesce(condition, F.lit(False)))


def parse_dates(text: Column) -> Column:
    """Dates written y-m-d, d/m/y, y/m/d or d-m-y; text of any other shape, or no real day, becomes null.

    Full ISO dates are cast as they are; the other shapes are turned into y-m-d first. Each text is
    parsed once and never fails its way through a list of formats.
    """
    clean = F.trim(text)
    plain = ((F.length(clean) == 10) & (F.substring(clean, 5, 1) == "-") & (F.substring(clean, 8, 1) == "-")
             & F.substring(clean, 10, 1).between("0", "9"))
    iso = F.regexp_replace(clean, DAY_FIRST, "$4-$3-$1")
    iso = F.regexp_replace(iso, YEAR_SLASH, "$1-$2-$3")
    return F.when(plain, clean.try_cast("date")).when(iso.rlike(YEAR_FIRST), iso.try_cast("date"))


def month_key(day: Column) -> Column:
    return F.year(day) * 100 + F.month(day)


def date_key(day: Column) -> Column:
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def year_of(key: Column | str) -> Column:
    col = F.col(key) if isinstance(key, str) else key
    return F.floor(col / 100).cast("int")


def month_index(key: Column | str) -> Column:
    """Months since year 0 of a YYYYMM key, so that month arithmetic is subtraction."""
    col = F.col(key) if isinstance(key, str) else key
    return year_of(col) * 12 + col % 100 - 1


def key_of_index(index: Column) -> Column:
    return (F.floor(index / 12) * 100 + index % 12 + 1).cast("int")


def quarter_key(key: Column | str) -> Column:
    """YYYYQ of a YYYYMM key."""
    col = F.col(key) if isinstance(key, str) else key
    return year_of(col) * 10 + F.floor((col % 100 + 2) / 3).cast("int")


def in_month_end_window(day: Column, days: int) -> Column:
    return (F.dayofmonth(day) > F.dayofmonth(F.last_day(day)) - days).cast("int")


# Band labels and their lower edges.
PERFORMANCE_BANDS = ((1.2, "Exceeding (>=120%)"), (1.0, "On Target (100-119%)"), (0.8, "Near Target (80-99%)"))
PERFORMANCE_FLOOR = "Below Target (<80%)"
ACHIEVEMENT_BANDS = ((0.6, "<60%"), (0.8, "60-79%"), (1.0, "80-99%"), (1.2, "100-119%"), (1.5, "120-149%"))
ACHIEVEMENT_TOP = "150%+"


def performance_band(achievement: Column, target: Column) -> Column:
    label = F.when(target.isNull(), "No Target")
    for edge, name in PERFORMANCE_BANDS:
        label = label.when(achievement >= edge, name)
    return label.otherwise(PERFORMANCE_FLOOR)


def achievement_band(achievement: Column, numbered: bool = False) -> Column:
    """Six half-open bands; null achievement is reported as having no target."""
    label = F.when(achievement.isNull(), "No Target")
    for i, (edge, name) in enumerate(ACHIEVEMENT_BANDS, start=1):
        label = label.when(achievement < edge, f"{i} {name}" if numbered else name)
    top = len(ACHIEVEMENT_BANDS) + 1
    return label.otherwise(f"{top} {ACHIEVEMENT_TOP}" if numbered else ACHIEVEMENT_TOP)


def band_number(achievement: Column) -> Column:
    number = F.when(achievement < ACHIEVEMENT_BANDS[0][0], 1)
    for i, (edge, _) in enumerate(ACHIEVEMENT_BANDS[1:], start=2):
        number = number.when(achievement < edge, i)
    return number.otherwise(len(ACHIEVEMENT_BANDS) + 1)


def tenure_band(months: Column) -> Column:
    """Right-closed tenure bands in months."""
    return (F.when(months <= -1, F.lit(None)).when(months <= 6, "0-6m").when(months <= 12, "6-12m").when(months <= 24, "1-2y")
            .when(months <= 48, "2-4y").when(months <= 999, "4y+"))
