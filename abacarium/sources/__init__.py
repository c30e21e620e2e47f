"""Scans, sinks, generators and versioned tables."""
