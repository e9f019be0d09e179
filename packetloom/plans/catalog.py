"""All registered queries: importing the modules registers them."""

from packetloom.plans import io, replication, reports, sensor  # noqa: F401
from packetloom.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
