"""Structured Streaming counterparts of the collection jobs; each equals its batch twin."""
