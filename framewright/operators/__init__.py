"""Relational operators on frames, artifacts, parameters, command lines and run events."""
