"""Stage composition (``etl``), the registered queries with their DuckDB
oracle (``registry``, ``oracle``) and the comparison harness."""
