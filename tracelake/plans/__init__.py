"""End-to-end jobs (``plans.jobs``), the registered query set with DuckDB oracles (``plans.queries``) and the
inputs those queries derive from the driver's tables (``plans.derive``)."""
