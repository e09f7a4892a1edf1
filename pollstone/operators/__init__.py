"""DataFrame operators: cleaning, deduplication, validation, rollups, metrics, ledgers."""
