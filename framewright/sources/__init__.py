"""Readers: config files, media files, video frames."""
