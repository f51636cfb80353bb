"""All queries of the core with their oracle SQL, by name."""

from __future__ import annotations

from terrane.plans import assembly_queries, data_queries, io_queries, polygon_queries, spatial_queries, structure_queries, table_queries, workflow

FLAGSHIP = "point_parcel_count"

MODULES = (data_queries, spatial_queries, table_queries, structure_queries, io_queries, workflow, assembly_queries, polygon_queries)
QUERIES = {name: f for m in MODULES for name, f in m.QUERIES.items()}
ORACLES = {name: s for m in MODULES for name, s in m.ORACLES.items()}
