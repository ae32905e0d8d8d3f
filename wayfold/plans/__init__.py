"""Package part: plans."""
