from feedworks.streaming.carried import event_rows_sink, fold_sink
from feedworks.streaming.run import (
    files_sink, index_sink, input_rows, run, sinks_together, table_sink, upsert_sink,
)

__all__ = [
    "event_rows_sink", "files_sink", "fold_sink", "index_sink", "input_rows", "run", "sinks_together",
    "table_sink", "upsert_sink",
]
