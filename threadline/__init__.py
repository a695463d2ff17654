"""Conversation analytics and corpus preparation as Spark jobs."""
