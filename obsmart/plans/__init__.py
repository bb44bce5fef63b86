"""Report, mart, serving and chain plans."""
