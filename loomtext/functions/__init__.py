"""Native column functions: metadata, markup, clean-up, lines."""
