"""Sources and sinks: stage listing and unload, the file loader, and the
tables the library keeps (manifest store, templates)."""

from .loader import LoadTemplate, load_files, load_results, load_stage, read_rejects, read_target
from .stage import list_stage, unload
from .tables import ManifestStore, clone_schema, empty_manifest, templates_table, write_templates

__all__ = [
    "LoadTemplate", "load_files", "load_results", "load_stage", "read_rejects", "read_target",
    "list_stage", "unload", "ManifestStore", "clone_schema", "empty_manifest", "templates_table",
    "write_templates",
]
