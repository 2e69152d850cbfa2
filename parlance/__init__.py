"""Spoken-corpus analytics on Spark."""
