"""Merchant and payment-terminal feature tables as PySpark DataFrame plans."""
