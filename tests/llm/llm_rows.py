"""Rows that every operator must take: nulls, empty and long texts, ties, repeats."""

LONG = " ".join(f"word{i * 7919 % 5003}" for i in range(30_000))
PASSAGE = " ".join(f"shared{i}" for i in range(70))

AWKWARD = [
    (1, None),
    (2, ""),
    (3, " \t\n"),
    (4, "Ein Ö und ß.\nEin Ö und ß."),
    (5, "plain words here\n" + PASSAGE + "\nend of five"),
    (6, "other words there\n" + PASSAGE + "\nend of six"),
    (7, LONG),
    (8, LONG),
    (9, "tie"),
    (9, "tie"),
    (9, "TIE, another text"),
    (None, "no id at all"),
    (None, None),
    (10, "a" * 1500),
    (11, "<|im_end|>\\ \x00 odd"),
    (12, "Plain  words\there\n" + PASSAGE + " \nend of five", None),
]
