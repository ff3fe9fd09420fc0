"""Readers. Each returns events, or parsed records with a ``reject`` reason."""
