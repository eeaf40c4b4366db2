"""Multi-source hazard monitoring on Spark: sensors, satellite pixels, messages, weather."""

__version__ = "0.1.0"
