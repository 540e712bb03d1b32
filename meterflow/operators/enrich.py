"""Readings and metrics joined with master data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.operators.lookup import lookup_join


def active_devices(devices: DataFrame) -> DataFrame:
    """Device-to-customer map of the active devices, by device."""
    return (
        devices.filter(F.col("device_status") == "ACTIVE")
        .select("device_id", "customer_id")
        .orderBy("device_id")
    )


def enrich_readings(
    readings: DataFrame, devices: DataFrame, customers: DataFrame, ship: bool | None = None
) -> DataFrame:
    """Readings with device and customer details; the customer is the one in the message.

    ``ship`` decides whether master tables go to every task, by default their size.
    """
    measured = readings.select("device_id", "customer_id", "energy_kwh", "voltage", "status")
    with_device = lookup_join(measured, devices.select("device_id", "device_model", "location"), "device_id", ship=ship)
    with_customer = lookup_join(
        with_device, customers.select("customer_id", "customer_name"), "customer_id", counted=measured, ship=ship
    )
    return with_customer.select(
        "device_id", "device_model", "location", "customer_name", "energy_kwh", "voltage", "status"
    )


def with_master_customer(
    metrics: DataFrame, devices: DataFrame, customers: DataFrame, ship: bool | None = None
) -> DataFrame:
    """Device metrics whose customer is the one the device master names.

    The two differ once a device has moved. Device and customer tables are
    joined first: both are small against the metrics.
    """
    owners = lookup_join(
        devices.select("device_id", "customer_id"), customers.select("customer_id"), "customer_id"
    )
    return lookup_join(metrics.drop("customer_id"), owners, "device_id", bound=devices, ship=ship)
