"""Sources and sinks: CSV feeds, layered tables, audit log, storage config."""

from tierforge.sources.io import (  # noqa: F401
    Layout,
    append_rows,
    configure_storage,
    read_feed,
    read_table,
    table_format,
    write_feed,
    write_table,
)
from tierforge.sources.schemas import AUDIT, FEEDS  # noqa: F401
