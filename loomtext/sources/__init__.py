"""Readers and writers: dump pages, site information, dump listings, JSON lines in size-bounded files."""
