"""The concrete warehouse: dimensions, facts, views, questions, measures, checks."""
