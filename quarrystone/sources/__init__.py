"""Readers of captured inputs."""
