"""DataFrame operators: gate, dedupe, rolling windows, anomalies, enrichment, checks."""
