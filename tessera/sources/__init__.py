"""Readers and parsers that turn files or driver tables into operator inputs."""
