"""zonecast.functions."""
