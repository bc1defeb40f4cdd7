"""Readers and writers: raw event zone, catalogs, staging area, star-schema adapter."""
