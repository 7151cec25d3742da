"""Operators on any DataFrame: latest rows, neighbours, ranks, reconciliation, deltas."""
