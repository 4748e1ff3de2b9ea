from oddsframe.sources.tables import (  # noqa: F401
    CANONICAL_SCHEMAS, Tables, fixture_tables, load_tables, read_history_csv, save_bucketed,
)

__all__ = ["CANONICAL_SCHEMAS", "Tables", "fixture_tables", "load_tables", "read_history_csv", "save_bucketed"]
