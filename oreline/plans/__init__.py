"""The sales warehouse: bronze, silver and gold models, reports, run log."""
