"""Dumps taken in as they arrive."""

from .arrivals import arrivals, ingest_arrivals, take_in

__all__ = ["arrivals", "ingest_arrivals", "take_in"]
