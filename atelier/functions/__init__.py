"""Pure column functions: text, imperial lengths, geometry, classification, scores."""
