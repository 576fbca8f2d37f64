"""Operators that prepare text corpora for training; nothing else imports this package."""
