from screenrank.sinks.tables import (  # noqa: F401
    overwrite_table, read_latest, replace_by_key, write_documents,
)
