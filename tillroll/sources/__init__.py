from tillroll.sources.files import dates_with_keys, read_delimited, read_documents, read_staged, text_schema
from tillroll.sources.jdbc import column_bounds, read_jdbc, read_jdbc_partitioned

__all__ = [
    "column_bounds",
    "dates_with_keys",
    "read_delimited",
    "read_documents",
    "read_jdbc",
    "read_jdbc_partitioned",
    "read_staged",
    "text_schema",
]
