"""Reading releases and report text; writing, publishing and reading tables."""
