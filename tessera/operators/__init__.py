"""Relational operators: temporal sets, lineage, matching, validation, OCR tables, corrections, work queues."""
