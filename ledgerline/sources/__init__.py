"""Scans, sinks, the table registry and the driver-table views."""
