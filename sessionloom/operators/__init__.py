"""DataFrame operators: features, pairs, matching, evaluation, segments, reports."""
