"""Recommendation features from behaviour events of short videos and live rooms, as Spark jobs."""
