"""Order documents for active clients."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def client_orders(orders: DataFrame, clients: DataFrame, status: str = "active") -> DataFrame:
    """Orders with the address of their client, for clients of one status.

    ``orders`` has ``client_id``, ``order_id``, ``n_objects``, ``volume`` and ``weight``.
    """
    chosen = clients.filter(F.col("status") == status).select("client_id", "address", "status", "lat", "lon")
    return orders.join(chosen, "client_id")


def order_documents(rows: DataFrame) -> DataFrame:
    """Flat client orders as nested documents."""
    return rows.select(
        "client_id",
        F.struct("address", "lat", "lon").alias("location"),
        "order_id",
        F.struct("n_objects", "volume", "weight").alias("order"),
        "status",
    )
