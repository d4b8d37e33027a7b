"""The registered queries; importing this package registers them."""

from trackloom.plans import detail_queries, evaluation_queries, file_queries, governance_queries, grid_queries, join_queries, kernel_queries, metric_queries, more_queries, output_queries, geometry_queries, scalar_queries, sequence_queries, source_queries, stream_queries, vector_queries  # noqa: F401
