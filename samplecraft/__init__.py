"""samplecraft: captured payloads in, flat samples and typed metrics out, on Spark."""

from samplecraft.session import prepare

__all__ = ["prepare"]
