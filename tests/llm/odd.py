"""Texts that every operator must take."""

#: Null, empty, white space, a single word, a very long text, other alphabets, and copies.
ODD = [None, "", " \n\t ", "word", "ab cd " * 30_000, "日本語 ünïcödé 🙂 \x00\x85　x", "same text here", "same text here"]
