"""Sources and sinks: KGX TSV readers, Parquet/TSV/JSON writers, configs."""

from .files import (cases_frame, predicate_menu, read_cases_yaml, read_edges_tsv,
                    read_nodes_tsv, read_predicate_config, read_quoted_tsv, read_resolved_jsonl, read_table,
                    read_vectors, write_answers_jsonl, write_edges, write_raw_tsv, write_resolved_jsonl, write_table,
                    write_tsv)

__all__ = ["cases_frame", "predicate_menu", "read_cases_yaml", "read_edges_tsv",
           "read_nodes_tsv", "read_predicate_config", "read_quoted_tsv", "read_resolved_jsonl", "read_table",
           "read_vectors", "write_answers_jsonl", "write_edges", "write_raw_tsv", "write_resolved_jsonl", "write_table",
           "write_tsv"]
