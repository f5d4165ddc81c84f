"""Relations derived from the driver's tables, and the compositions that queries run."""
