"""Readers and sinks."""

from titleflow.sources.images import read_images
from titleflow.sources.tables import (FEATURES_SCHEMA, LABELS_SCHEMA,
                                      METRIC_LOG_SCHEMA, append_metrics,
                                      read_features, read_labelled, read_labels,
                                      read_metrics, read_table,
                                      read_token_vectors, read_vocab, replace_metrics,
                                      without_labels, write_submission)

__all__ = [
    "FEATURES_SCHEMA", "LABELS_SCHEMA", "METRIC_LOG_SCHEMA", "append_metrics",
    "read_features", "read_images", "read_labelled", "read_labels",
    "read_metrics", "read_table", "read_token_vectors", "read_vocab", "replace_metrics",
    "without_labels", "write_submission",
]
