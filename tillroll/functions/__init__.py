from tillroll.functions.casts import align_keys, date_literal, null_on_error
from tillroll.functions.columns import (
    drop_columns,
    flatten_struct,
    item_count,
    null_or_marker,
    time_parts,
    with_batch_date,
)

__all__ = [
    "align_keys",
    "date_literal",
    "drop_columns",
    "flatten_struct",
    "item_count",
    "null_on_error",
    "null_or_marker",
    "time_parts",
    "with_batch_date",
]
