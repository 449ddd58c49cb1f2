"""Query plans: ingest, staging, facts, marts, checks and dashboards."""
