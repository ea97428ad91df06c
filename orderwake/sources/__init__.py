from .change_log import ChangeLogTable
from .files import File, fingerprints
from .ingest import rename_columns, rename_table, resolve_change_log, conform, typed
from .readers import read_extracts, read_optional, read_table, read_tables, read_typed
from .sinks import read_json_rows, read_report, write_json_rows, write_report, write_table
from .workspace import Workspace, files_folder, scratch_folder

__all__ = [
    "ChangeLogTable",
    "File",
    "Workspace",
    "conform",
    "files_folder",
    "fingerprints",
    "read_extracts",
    "read_json_rows",
    "read_optional",
    "read_report",
    "read_table",
    "read_tables",
    "read_typed",
    "rename_columns",
    "rename_table",
    "resolve_change_log",
    "scratch_folder",
    "typed",
    "write_json_rows",
    "write_report",
    "write_table",
]
