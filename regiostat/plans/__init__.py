"""Composite jobs (bronze -> silver -> gold) and the registered queries."""
