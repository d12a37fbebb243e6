"""Typed readers, sinks and lineage cuts (materialisation)."""

from tessera.sources.readers import (
    TWEETS_SCHEMA, Loaded, load_csv, load_json, read_conditions_csv, read_documents_json,
    read_parquet, read_table,
)
from tessera.sources.sinks import (
    read_ordered, write_ordered, write_parquet, write_rule_lines, write_top_itemsets_tsv,
)
from tessera.sources.storage import checkpoint_root, materialize, new_folder, release, row_count
from tessera.sources.store import ResultStore, input_fingerprint, path_fingerprint

__all__ = [
    "TWEETS_SCHEMA", "Loaded", "ResultStore", "input_fingerprint", "load_csv", "load_json", "new_folder",
    "path_fingerprint", "read_ordered", "write_ordered", "read_conditions_csv", "read_documents_json",
    "read_parquet", "read_table", "write_parquet", "write_rule_lines",
    "write_top_itemsets_tsv", "checkpoint_root", "materialize", "release", "row_count",
]
