"""Reports and end-to-end jobs made of the operators."""
