"""Readers of lab tables and rule tables, sinks, and saved intermediate tables."""
