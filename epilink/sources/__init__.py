"""Readers: tables, logs, dictionaries, topics, payload columns and triples."""

from .batches import Entry, entries, is_batch_table, live, read_batches, read_log
from .graph_store import read_graph, read_statistics
from .ntriples import parse_ntriples, read_ntriples, read_rejected_ntriples, rejected_ntriples
from .payloads import explode_json_map, flatten_weather, parse_feed_items, parse_json, quarantine_json, rejected_feeds
from .tables import path_exists, read_json_map, read_metrics, read_optional, read_table, read_triples, union_all
from .topics import read_topic, stream_table
