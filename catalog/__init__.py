"""Registered queries: each runs an operator over whole tables; most have the same result stated in SQL."""

from catalog import combining, keys, metering, payloads, responses, rows, shapes, sources, streams, values
from catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "combining", "keys", "metering", "payloads", "responses", "rows", "shapes", "sources", "streams", "values"]
