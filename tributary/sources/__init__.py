"""Readers, catalog lookups and shared scratch space."""

from tributary.sources.activity import to_event_records
from tributary.sources.catalog import (
    Described,
    Relation,
    described_tables,
    relations_by_pattern,
    relations_by_prefix,
)
from tributary.sources.events import (
    EVENT_SCHEMA,
    read_event_tables,
    read_events,
    write_event_tables,
)
from tributary.sources.footers import read_footers
from tributary.sources.scratch import clear_scratch, scratch_path, stored
from tributary.sources.seeds import read_seed
from tributary.sources.versions import (
    Version,
    current_version,
    publish,
    publish_table,
    published_versions,
    read_version,
    release_tables,
    release_versions,
    table_versions,
    version_age,
    write_table_version,
    write_version,
)

__all__ = [
    "Described",
    "EVENT_SCHEMA",
    "Relation",
    "Version",
    "clear_scratch",
    "current_version",
    "described_tables",
    "publish",
    "publish_table",
    "published_versions",
    "read_event_tables",
    "read_events",
    "read_footers",
    "read_seed",
    "read_version",
    "relations_by_pattern",
    "relations_by_prefix",
    "release_tables",
    "release_versions",
    "scratch_path",
    "stored",
    "table_versions",
    "to_event_records",
    "version_age",
    "write_event_tables",
    "write_table_version",
    "write_version",
]
