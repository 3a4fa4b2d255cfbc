"""Outbox synchronisation on Spark: claim, enrich, package, settle, report."""
