"""Query catalogue and plan helpers (size-checked broadcast, caching,
lineage cuts, plan inspection)."""
