from segmentry.sources.events import (
    coerce_events,
    exact_sample,
    load_events,
    prepare_events,
    read_table,
    row_count,
    take_rows,
    union_inputs,
)
from segmentry.sources.sinks import read_feature_names, write_csv, write_feature_names, write_text

__all__ = [
    "coerce_events",
    "exact_sample",
    "load_events",
    "prepare_events",
    "read_feature_names",
    "read_table",
    "row_count",
    "take_rows",
    "union_inputs",
    "write_csv",
    "write_feature_names",
    "write_text",
]
