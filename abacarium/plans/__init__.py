"""Named queries on the driver tables, each next to its check in SQL."""
