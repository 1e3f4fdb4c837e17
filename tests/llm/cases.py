"""Rows that operators must stand: nulls, empty, blank, equal, repeated, very long and odd texts."""

AWKWARD = [
    (1, "The cat sat on the mat and then it slept.\nThe cat sat on the mat and then it slept.\nA line of its own, here.", "en", "a", 1),
    (2, None, None, None, None),
    (3, "", "en", "a", 0),
    (4, " \t\n\r ", "en", None, 4),
    (5, "The cat sat on the mat and then it slept.\nThe cat sat on the mat and then it slept.\nA line of its own, here.", "en", "a", 1),
    (5, "The cat sat on the mat and then it slept.\nThe cat sat on the mat and then it slept.\nA line of its own, here.", "en", "a", 1),
    (6, "the cat sat", "en", "b", 11),
    (7, "THE cat SAT", "en", "b", 11),
    (8, "word " * 30_000, "en", "c", 150_000),
    (9, "x" * 200_000, "en", "c", 200_000),
    (10, "L'été, où Ünïcode “naïve” 🙂👍 <|endoftext|> é \x1c 　 don't 123 #$% a\n\nb", "fr", "d", 60),
    (None, "a text that has no id of its own", "en", None, None),
    (None, "a text that has no id of its own", "en", None, None),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
