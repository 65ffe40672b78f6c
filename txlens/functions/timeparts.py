"""Date and time expressions of the retail layers."""

from pyspark.sql import functions as F

INVOICE_DATE_FORMAT = "M/d/yyyy H:mm"
DAY_NAMES = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


def parse_invoice_date(column, fmt=INVOICE_DATE_FORMAT):
    """Timestamp of an invoice date text; unreadable text gives NULL."""
    return F.try_to_timestamp(F.col(column), F.lit(fmt))


def hour_number(column):
    return F.hour(column).cast("double")


def day_number(column):
    return F.dayofmonth(column).cast("double")


def month_number(column):
    return F.month(column).cast("double")


def weekday_number(column, week_start="sunday"):
    """0..6 counted from Sunday (batch layers) or from Monday (dashboard tables)."""
    if week_start == "sunday":
        return (F.dayofweek(column) - 1).cast("double")
    if week_start == "monday":
        return F.weekday(column).cast("double")
    raise ValueError(f"week_start must be sunday or monday, not {week_start!r}")


def month_label(column):
    return F.date_format(column, "yyyy-MM")


def day_name(column):
    return F.date_format(column, "EEEE")


def calendar_day(column):
    return F.to_date(column)


def days_between(later, earlier):
    return F.datediff(later, earlier)


def timestamp_text(column):
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss")


def id_text(column):
    """Numeric id such as ``17850.0`` as the text ``17850``."""
    return F.col(column).try_cast("double").cast("bigint").cast("string")


def weekday_table(spark):
    """The seven days in calendar order, Monday first."""
    names = F.array(*[F.lit(name) for name in DAY_NAMES])
    return spark.range(7).select(
        F.col("id").cast("int").alias("DayNum"),
        F.element_at(names, F.col("id").cast("int") + 1).alias("Day"),
    )
