from feedkit.sources.config import load_json
from feedkit.sources.feeds import (
    SplitFeed,
    list_files,
    read_feed,
    read_fixed_width,
    read_positional,
    read_widths,
    read_with_header,
    split_feed,
)
from feedkit.sources.options import csv_options
from feedkit.sources.tables import list_tables, preview, read_table

__all__ = [
    "SplitFeed",
    "csv_options",
    "list_files",
    "list_tables",
    "load_json",
    "preview",
    "read_feed",
    "read_fixed_width",
    "read_positional",
    "read_table",
    "read_widths",
    "read_with_header",
    "split_feed",
]
