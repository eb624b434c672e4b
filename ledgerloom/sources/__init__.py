"""Readers, writers and the adapters that shape the test tables into job inputs."""
