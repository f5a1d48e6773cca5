from feedkit.functions.columns import (
    map_all,
    map_by_index,
    map_by_name,
    map_by_position,
    substring_columns,
    with_function,
)
from feedkit.functions.hashing import row_hash
from feedkit.functions.types import cast_as, spark_type, sql_expression

__all__ = [
    "cast_as",
    "map_all",
    "map_by_index",
    "map_by_name",
    "map_by_position",
    "row_hash",
    "spark_type",
    "sql_expression",
    "substring_columns",
    "with_function",
]
