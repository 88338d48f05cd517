"""Writers of datasets and run artefacts."""
