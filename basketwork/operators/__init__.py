"""DataFrame -> DataFrame operators: star schema, checks, lineage, analytics."""
