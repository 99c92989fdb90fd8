"""DataFrame -> DataFrame operators over article tables."""
