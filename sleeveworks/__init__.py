"""Spark pipeline that turns scanned record sleeves and audio inventories into catalogue tables."""
