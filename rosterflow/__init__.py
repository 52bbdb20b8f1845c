"""Rosterflow: people and company data processing expressed as Spark plans."""
