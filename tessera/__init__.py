"""Tessera: record linkage, validated panels and corpus preparation on Spark."""
