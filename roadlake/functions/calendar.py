"""Attributes of a calendar day and of a 15-minute slot, as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from roadlake.functions import codes
from roadlake.functions.lookup import nth


def date_key(day: Column) -> Column:
    """Day as the integer YYYYMMDD."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def slot_of(at: Column) -> Column:
    """Index 0..95 of the 15-minute slot a timestamp falls in."""
    return ((F.hour(at) * 60 + F.minute(at)) / codes.WINDOW_MINUTES).cast("int")


def iso_weekday(day: Column) -> Column:
    return F.weekday(day) + 1


def day_attributes(day: Column) -> dict[str, Column]:
    month, weekday = F.month(day), iso_weekday(day)
    weekend = weekday.isin(codes.WEEKEND_ISO_DAYS)
    return {
        "date_key": date_key(day),
        "full_date": day,
        "year": F.year(day),
        "quarter": F.quarter(day),
        "month": month,
        "month_name_en": F.date_format(day, "MMMM"),
        "month_name_ar": nth(codes.MONTHS_AR, month - 1),
        "week_of_year": F.weekofyear(day),
        "day_of_month": F.dayofmonth(day),
        "day_of_week": weekday,
        "day_name_en": F.date_format(day, "EEEE"),
        "day_name_ar": nth(codes.DAYS_AR, weekday - 1),
        "is_weekend": weekend,
        "is_public_holiday": F.lit(False),
        "holiday_name": F.lit(None).cast("string"),
        "is_ramadan": F.lit(False),
        "is_school_term": F.lit(False),
        "season": nth(codes.SEASONS, (month % 12) / 3),
        "day_type": F.when(weekend, F.lit("Weekend")).otherwise(F.lit("Weekday")),
    }


def slot_attributes(slot: Column) -> dict[str, Column]:
    minute_of_day = slot * codes.WINDOW_MINUTES
    hour = (minute_of_day / 60).cast("int")
    minute = minute_of_day % 60
    am, pm = hour.between(*codes.PEAK_AM_HOURS), hour.between(*codes.PEAK_PM_HOURS)
    overnight = hour < codes.OVERNIGHT_BEFORE_HOUR
    return {
        "time_key": slot,
        "hour": hour,
        "minute": minute,
        "period_label": F.format_string("%02d:%02d", hour, minute),
        "is_peak_am": am,
        "is_peak_pm": pm,
        "is_off_peak": ~(am | pm | overnight),
        "is_overnight": overnight,
    }
