"""Writers.  Keyed ones are append-only per micro-batch and resolved on read."""
