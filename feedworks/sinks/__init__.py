from feedworks.sinks.files import to_json_lines, write_batch, write_files
from feedworks.sinks.index import index_options, write_index
from feedworks.sinks.small_files import pack_files, pack_table
from feedworks.sinks.tables import create_or_append
from feedworks.sinks.upsert import compact, current_state, expire, keyed_upsert

__all__ = [
    "compact", "create_or_append", "current_state", "expire", "index_options",
    "keyed_upsert", "pack_files", "pack_table", "to_json_lines", "write_batch", "write_files", "write_index",
]
