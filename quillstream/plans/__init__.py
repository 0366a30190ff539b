"""Plans: how operators are put together and sized."""
