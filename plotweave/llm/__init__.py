"""Operators for training data: entity fusion and matching, canonical values,
tokenizing, leakage search and sentence units. Nothing else imports this."""
