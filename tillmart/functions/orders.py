"""Attributes derived from an order header, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import blank_to_null

# Separator between brand and channel in a sub order type.
SEPARATOR = " - "

# Brand spellings (lower case, single spaces, "and" as "&").
BRAND_NAMES = {
    "thepla house": "Thepla House By Tejals",
    "thepla house by tejals": "Thepla House By Tejals",
    "homely healthy": "Homely & Healthy",
    "homely & healthy": "Homely & Healthy",
    "homely & healthy app": "Homely & Healthy",
}

# Channel spellings (lower case).
PLATFORM_NAMES = {
    "swiggy": "Swiggy",
    "swiggy (toing)": "Swiggy",
    "zomato": "Zomato",
    "delivery": "Delivery",
    "pick up": "Pick Up",
    "dine in": "Dine In",
}

KNOWN_BRANDS = sorted(set(BRAND_NAMES.values()))
KNOWN_PLATFORMS = sorted(set(PLATFORM_NAMES.values()))

# Channels that carry no brand.
BRANDLESS_PLATFORMS = ("Delivery", "Pick Up", "Dine In")

# Dayparts as inclusive (first, last) times of day. The seconds
# after :59:00 up to the next full hour belong to no daypart.
DAYPARTS = (
    ("Breakfast", "05:00", "10:59"),
    ("Lunch", "11:00", "15:59"),
    ("Snacks", "16:00", "18:59"),
    ("Dinner", "19:00", "22:59"),
)
LATE_NIGHT = ("Late Night", "23:00", "04:59")


def _lookup(names: dict[str, str], key: Column, otherwise: Column) -> Column:
    pairs = [F.lit(part) for pair in names.items() for part in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), key), otherwise)


def raw_platform(text: Column) -> Column:
    """Part of a stripped sub order type after its last separator, or all of it."""
    return blank_to_null(F.substring_index(text, SEPARATOR, -1))


def raw_brand(text: Column) -> Column:
    """Part of a stripped sub order type before its last separator, else NULL."""
    tail = F.char_length(F.substring_index(text, SEPARATOR, -1)) + len(SEPARATOR)
    head = F.substring(text, F.lit(1), F.char_length(text) - tail)
    return F.when(F.contains(text, F.lit(SEPARATOR)), blank_to_null(head))


def brand_key(brand: Column) -> Column:
    """Spelling under which a stripped brand is looked up."""
    unified = F.regexp_replace(F.lower(brand), r"(?U)\band\b", "&")
    return F.regexp_replace(unified, r"(?U)\s+", " ")


def standard_brand(brand: Column) -> Column:
    """Canonical name of a stripped brand; unknown brands pass through."""
    return _lookup(BRAND_NAMES, brand_key(brand), brand)


def standard_platform(platform: Column) -> Column:
    """Canonical name of a stripped channel; unknown channels pass through."""
    return _lookup(PLATFORM_NAMES, F.lower(platform), platform)


def calendar(timestamp: Column) -> dict[str, Column]:
    """Calendar attributes of a timestamp; all NULL for NULL."""
    return {
        "business_date": F.to_date(timestamp),
        "weekday": F.date_format(timestamp, "EEEE"),
        "month": F.month(timestamp).cast("bigint"),
        "month_name": F.date_format(timestamp, "MMMM"),
        "quarter": F.quarter(timestamp).cast("bigint"),
        "year": F.year(timestamp).cast("bigint"),
    }


def _minute(clock: str) -> int:
    hours, minutes = clock.split(":")
    return int(hours) * 60 + int(minutes)


def daypart(timestamp: Column) -> Column:
    """Daypart label of a timestamp; NULL in the gaps between dayparts."""
    begun = F.hour(timestamp) * 60 + F.minute(timestamp)
    # Ends are whole minutes and inclusive: any second or fraction is past them.
    past = F.when(F.extract(F.lit("SECOND"), timestamp) > 0, 1).otherwise(0)
    label, first, last = LATE_NIGHT
    result = F.when((begun >= _minute(first)) | (begun + past <= _minute(last)), label)
    for label, first, last in DAYPARTS:
        result = result.when(
            (begun >= _minute(first)) & (begun + past <= _minute(last)), label
        )
    return result


def validation_errors(
    brand: Column, platform: Column, business_date: Column, part: Column
) -> Column:
    """Messages about one order's derived attributes, in fixed order."""
    branded_channel = platform.isNotNull() & ~platform.isin(*BRANDLESS_PLATFORMS)
    checks = (
        (~brand.isin(*KNOWN_BRANDS), "Unknown brand"),
        (~platform.isin(*KNOWN_PLATFORMS), "Unknown platform"),
        (business_date.isNull(), "Missing business date"),
        (part.isNull(), "Missing daypart"),
        (brand.isNotNull() & platform.isNull(), "Brand exists without platform"),
        (brand.isNull() & branded_channel, "Platform exists without brand"),
    )
    return F.array_compact(F.array(*[F.when(failed, F.lit(text)) for failed, text in checks]))


def cancel_reason(status: Column, reason: Column) -> Column:
    """Reason shown in reports: successes and missing reasons get a label."""
    return (
        F.when(status == "Success", "Not Cancelled")
        .when(reason.isNull(), "Unknown")
        .otherwise(reason)
    )


def performance(average_minutes: Column) -> Column:
    """Kitchen rating from an average preparation time."""
    return (
        F.when(average_minutes < 10, "Excellent")
        .when(average_minutes < 15, "Good")
        .otherwise("Needs Attention")
    )
