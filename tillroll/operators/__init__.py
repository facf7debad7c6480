from tillroll.operators.copies import count_copies, repeat_copies
from tillroll.operators.joins import left_join, left_join_batch, left_join_repeated
from tillroll.operators.keys import add_key, dense_key, repeated_keys, unique_key
from tillroll.operators.preview import preview

__all__ = [
    "add_key",
    "count_copies",
    "dense_key",
    "left_join",
    "left_join_batch",
    "left_join_repeated",
    "preview",
    "repeat_copies",
    "repeated_keys",
    "unique_key",
]
