"""The same event logic over streams."""
