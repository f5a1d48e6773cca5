from feedkit.sinks.tables import append_by_name, create_table, load_positional, overwrite_table, run_sql, truncate

__all__ = ["append_by_name", "create_table", "load_positional", "overwrite_table", "run_sql", "truncate"]
