"""Sources and sinks: raw feeds, versioned tables, JSON files, change feeds."""

from strata.sources.bronze import read_kafka, split_by_topic, to_bronze, typed_view
from strata.sources.changes import envelope_payload, initial_snapshot, snapshot_changes
from strata.sources.feeds import API_TOPIC, CDC_TOPIC, api_feed, change_feed
from strata.sources.files import as_messages, read_json_tree, write_json_lines, write_kafka
from strata.sources.keyed import KeyedTable
from strata.sources.landing import LandedTable
from strata.sources.tables import VersionedTable, table_exists

__all__ = [
    "API_TOPIC",
    "CDC_TOPIC",
    "KeyedTable",
    "LandedTable",
    "VersionedTable",
    "api_feed",
    "as_messages",
    "change_feed",
    "envelope_payload",
    "initial_snapshot",
    "read_json_tree",
    "read_kafka",
    "snapshot_changes",
    "split_by_topic",
    "table_exists",
    "to_bronze",
    "typed_view",
    "write_json_lines",
    "write_kafka",
]
