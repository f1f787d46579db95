"""DataFrame-to-DataFrame steps, each valid for a batch and for a stream."""
