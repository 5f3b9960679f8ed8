"""Streaming jobs: one query per topic that fills all of the topic's tables."""
