"""Bibliographic analytics and corpus preparation as DataFrame-to-DataFrame transforms on Spark."""
