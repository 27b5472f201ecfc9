from citystream.sources import feeds, kafka, lookups, tables

__all__ = ["feeds", "kafka", "lookups", "tables"]
