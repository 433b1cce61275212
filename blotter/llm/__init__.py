"""Operators for preparing training data at scale; nothing else imports them."""
