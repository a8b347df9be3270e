"""Registered queries (Spark) and their SQL oracles, plus plan inspection."""
