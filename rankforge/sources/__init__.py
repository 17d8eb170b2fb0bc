"""Sources and sinks: CSV / JSON readers and writers, export with a
metadata sidecar, and string staging with checked casts."""

from rankforge.sources.files import (  # noqa: F401
    export_json,
    export_meta,
    read_csv_glob,
    read_csv_table,
    read_json_records,
    write_csv,
)
from rankforge.sources.staging import (  # noqa: F401
    read_staged,
    stage_and_cast,
    staged,
    string_stage,
    write_staged,
)
