"""Operators for preparing training text, with their queries.  Nothing else imports this package."""
