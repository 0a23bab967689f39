"""Building blocks: scratch tables, exact ranks, exact medians, dimensions, facts, checks."""
