"""Query plans over the test tables: bindings (test tables -> domain inputs) and the
registered queries (``q_*`` modules), each paired with its DuckDB oracle."""
