"""Readers (action log, user and product dimensions, tasks), data
generators and sinks."""
