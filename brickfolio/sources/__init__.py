"""Readers: archives, XML reports, registers, web pages and partitioned tables."""
