"""Readers and writers; every format and option comes from the caller."""
