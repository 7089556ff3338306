"""Logs that live half in a live append log and half in an archive, on Spark."""
