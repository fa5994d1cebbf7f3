"""Operators of a training-data pipeline, one module each. Nothing else imports this package."""
