"""flowlab: network flow analytics expressed as Spark DataFrame programs."""

__version__ = "0.1.0"
