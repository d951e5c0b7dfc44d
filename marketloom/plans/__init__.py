"""Registry of all operators, and the independent SQL they are checked against."""
