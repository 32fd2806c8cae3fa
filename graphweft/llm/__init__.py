"""Operators for preparing large text collections. Nothing else in the package imports this."""
