"""Part of tendril; see the README."""
