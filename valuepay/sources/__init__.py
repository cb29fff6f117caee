"""Sources: typed CSV landing with type repair, and adapters over the driver's tables."""
