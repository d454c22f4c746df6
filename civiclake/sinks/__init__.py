"""Sinks: path and catalog writes with observed row counts, published versions, comments."""

from civiclake.sinks.published import is_published, latest_version, publish, read_published, recover, versions  # noqa: F401
from civiclake.sinks.writers import (  # noqa: F401
    comment_columns,
    comment_table,
    publish_version,
    register_table,
    save_table,
    write_path,
)
