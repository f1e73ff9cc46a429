"""Table operators and batch jobs for hourly sensor data and layered tables."""

__version__ = "0.1.0"
