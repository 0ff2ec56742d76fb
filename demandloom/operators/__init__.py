"""Lazy DataFrame operators; the few that need a number first run a bounded aggregate."""
