"""End-to-end plans, test-table adapters and the query catalogue."""
