"""Sources: landed API pages and stored tables."""

from civiclake.sources.envelope import bronze, conform, empty, page_completeness, read_pages, records  # noqa: F401
from civiclake.sources.tables import of_type, period, read_bulk, read_path, read_table  # noqa: F401
