"""zonecast.sinks."""
