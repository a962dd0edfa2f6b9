"""The four feature tables, composed from the operators."""
