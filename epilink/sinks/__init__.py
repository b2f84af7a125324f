"""Writers: tables, logs, messages, dictionaries and graph files."""

from .batches import clean_up, compact, replace_all, spread, write_batch
from .dictionaries import read_dictionary, update_dictionary, write_dictionary, write_json_map
from .graph_files import (
    ntriples_lines,
    predicate_tags,
    predicates_of,
    rdfxml_rows,
    turtle_blocks,
    write_ntriples,
    write_rdfxml,
    write_turtle,
)
from .graph_store import merge_graph
from .messages import publish, to_messages
from .tables import append_metrics, upsert_by_key, write_graph, write_table, write_triples
