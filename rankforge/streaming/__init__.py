"""Streaming entry points. The source work has no streams, windows or
late data; the only stream here is the continuous form of the bulk CSV
import (file source -> checked casts -> accepted / rejected tables)."""

from rankforge.streaming.ingest import import_stream, read_imported, string_schema  # noqa: F401
