from feedkit.operators.dimension import Load
from feedkit.operators.mapping import apply_mapping, compare_layout, conform, rename, rename_by_mapping
from feedkit.operators.merge import merge_into, merge_upsert
from feedkit.operators.quality import report
from feedkit.operators.type2 import scd2

__all__ = [
    "Load",
    "apply_mapping",
    "compare_layout",
    "conform",
    "merge_into",
    "merge_upsert",
    "rename",
    "rename_by_mapping",
    "report",
    "scd2",
]
