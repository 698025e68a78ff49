"""Readers and writers: text lines, CSV with fixed schemas, literal rows,
adjacency-list text, pair-text sink, preview/schema views."""

from kiln.sources.readers import (MOVIE_SCHEMA, RATING_SCHEMA, EDGE_SCHEMA,
                                  VERTEX_SCHEMA, read_lines, read_csv_fixed,
                                  read_movies, read_ratings, read_vertices,
                                  read_edges, rows_to_frame, conform, spread)
from kiln.sources.adjacency import (parse_adjacency, adjacency_edges, edges_from_lines,
                                    vertices_from_lines)
from kiln.sources.sinks import (pair_text, write_pair_text, write_placed_pairs, read_parts,
                                preview, schema_rows)

__all__ = ["MOVIE_SCHEMA", "RATING_SCHEMA", "EDGE_SCHEMA", "VERTEX_SCHEMA",
           "read_lines", "read_csv_fixed", "read_movies", "read_ratings",
           "read_vertices", "read_edges", "rows_to_frame", "conform", "spread",
           "parse_adjacency", "adjacency_edges", "edges_from_lines",
           "vertices_from_lines", "pair_text", "write_pair_text",
           "write_placed_pairs", "read_parts",
           "preview", "schema_rows"]
