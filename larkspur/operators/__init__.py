"""DataFrame -> DataFrame operators (batch; most also run on streaming frames)."""
