"""Operators for language-model training data; nothing else in rosterflow imports this subpackage."""
