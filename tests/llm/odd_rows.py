"""Rows that every operator must bear."""

#: Nulls in every column, empty and blank texts, ties, repeated rows, a very long text.
ODD = [
    (None, "one two three four", None, None), (1, None, "en", "a"), (2, "", "en", "a"),
    (3, " \t\n", None, "b"), (4, "one two three four", "en", None), (5, "one  two\nthree four", "en", "b"),
    (5, "one  two\nthree four", "en", "b"), (6, "Ünïcödé 日本語 %%% ...", "fr", "c"),
    (7, "word " * 60_000, "en", "a"), (8, "12345 678", "de", "b"), (9, "x" * 250_000, "en", "c"),
]
