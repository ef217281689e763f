"""Conversation analytics on Spark: discovery, trees, state, classification, comparison."""
