"""Sources (catalog / file scans, fixture mapping) and sinks (publishing)."""

from spanpack.sources.publish import (
    drop_old_versions,
    publish,
    publish_append,
    publish_overwrite,
    publish_split,
    publish_swap,
    ranged,
    read_split,
)
from spanpack.sources.tables import load_sources, read_era_table, read_source
from spanpack.sources.versions import publish_version, read_version

__all__ = [
    "load_sources",
    "publish",
    "publish_append",
    "publish_overwrite",
    "publish_split",
    "publish_version",
    "ranged",
    "read_split",
    "read_version",
    "publish_swap",
    "drop_old_versions",
    "read_era_table",
    "read_source",
]
