"""Readers. Every reader returns a DataFrame in the bronze shape or a documented intermediate."""
