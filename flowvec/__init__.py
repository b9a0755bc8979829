"""Flow, packet and document analytics with vector search on Spark."""
