"""Query catalog: derived inputs and registered queries with DuckDB twins."""
