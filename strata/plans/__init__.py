"""Composite plans: medallion layers, the normaliser, reports and the test-table binding."""
