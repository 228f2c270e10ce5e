"""Reports and the full run, composed from the operators."""
