"""zonecast.plans."""
