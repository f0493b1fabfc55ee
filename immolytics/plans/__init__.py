"""Composed plans: the binding of the driver's tables and the end-to-end flows."""
