"""Writers: image manifests and config files."""
