"""Column expressions shared by batch and streaming plans. All stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0088


def event_time(text: Column) -> Column:
    """ISO-8601 UTC text, with or without fraction, to a timestamp; null when it does not parse."""
    return F.try_to_timestamp(text)


def iso_millis(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def ratio(num: Column, den: Column) -> Column:
    """num / den, null when den is zero."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in kilometres."""
    half_lat = F.radians(lat2 - lat1) / 2
    half_lon = F.radians(lon2 - lon1) / 2
    chord = (F.pow(F.sin(half_lat), 2.0)
             + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(half_lon), 2.0))
    return F.asin(F.sqrt(F.least(chord, F.lit(1.0)))) * (2 * EARTH_RADIUS_KM)


def device_hash(device_id: Column, salt: str) -> Column:
    return F.sha2(F.concat(device_id, F.lit(salt)), 256)


def mask_ip(ip: Column) -> Column:
    """Keep the /24 network and replace the last octet; an already masked address is unchanged."""
    return F.regexp_replace(ip, r"\.[^.]+$", ".x")


def experiment_group(user_id: Column) -> Column:
    """Fixed holdout: one user in ten is CONTROL, decided by the id alone."""
    return F.when(F.crc32(user_id) % 10 == 0, F.lit("CONTROL")).otherwise(F.lit("TREATMENT"))


def is_gmv(status: Column, txn_type: Column) -> Column:
    """A transaction counts as merchandise volume when it is a successful payment."""
    return (status == "SUCCESS") & (txn_type == "PAYMENT")


def sum_if(cond: Column, value: Column) -> Column:
    """Sum of value over the rows that satisfy cond; zero when there are none."""
    return F.coalesce(F.sum(F.when(cond, value)), F.lit(0).cast("bigint"))


def grid_cell(degrees: Column, size: float) -> Column:
    return F.floor(degrees / F.lit(size)).cast("bigint")


def money(amount: Column) -> Column:
    """A whole amount as an exact decimal, ready to be multiplied with a rate."""
    return amount.cast("decimal(20,0)")


def rounded_money(amount: Column) -> Column:
    return F.round(amount, 2).cast("double")
