"""Texts that every operator must survive: null, empty, blank, one word, a tie, a long text."""

ODD = [None, "", " \n\t ", "one", "one", "\n\n\n", "é ß ñ \U0001f600", "a" * 50_000, "w " * 30_000]
