"""Relational operators of the session analysis: task filters, session
roll-up with the user join, and the statistics aggregate."""
