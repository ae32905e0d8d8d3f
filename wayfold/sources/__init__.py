"""Package part: sources."""
