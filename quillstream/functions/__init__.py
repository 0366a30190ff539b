"""Column functions and the small helpers that run inside Arrow tasks."""
