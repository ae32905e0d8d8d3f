"""Package part: operators."""
