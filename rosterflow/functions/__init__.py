"""Part of rosterflow; see README.md."""
