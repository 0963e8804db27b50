"""What a run is told: the pipeline's stages and the training config."""
