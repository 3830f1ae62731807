"""Sources: the driver-table adapter (bronze feeds) and table readers
(partitioned, snapshot, footer-type drift)."""
