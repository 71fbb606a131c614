"""DataFrame to DataFrame operators; batch and streaming frames alike."""
