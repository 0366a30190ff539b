"""Message sources and the stored change log."""
