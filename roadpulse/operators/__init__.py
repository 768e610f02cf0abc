"""DataFrame operators: pairing, thresholds, marks, episodes, trips, scores, cells."""
