"""Table-to-table operators built from joins, groupings and windows."""
