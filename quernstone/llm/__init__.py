"""Operators for language-model training data. Nothing else imports this package."""
