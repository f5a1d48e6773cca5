from feedkit.plans.change_log import create_logged, first_rows, fold, load_logged, merge_logged
from feedkit.plans.dimension_load import LoadRejected, LoadResult, create_dimension, create_snapshot, load_dimension
from feedkit.plans.stage_load import create_loaded, ledger, load_new_files, stage_load

__all__ = [
    "LoadRejected",
    "LoadResult",
    "create_dimension",
    "create_loaded",
    "create_logged",
    "create_snapshot",
    "first_rows",
    "fold",
    "ledger",
    "load_dimension",
    "load_logged",
    "load_new_files",
    "merge_logged",
    "stage_load",
]
