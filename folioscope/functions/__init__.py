"""Column functions: text, identity keys, dates and HTML."""
