"""Readers and writers: landed files, feeds, image folders, topics, catalog tables."""
