"""Sources: driver tables, panel projections, JSON documents, snapshots."""
