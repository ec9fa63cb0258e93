"""Composed models: silver cleaning, gold metrics, legacy enrichment, issue cleaning, full job."""
