"""Report files in, fact tables out."""
