#: Null and empty texts, a repeated row, a tie, an odd script, long and short ones.
TEXTS = [
    (1, "one two three four five six seven eight nine ten"),
    (2, None),
    (3, ""),
    (4, "  \n\t "),
    (5, "one two three four five six seven eight nine ten"),
    (5, "one two three four five six seven eight nine ten"),
    (6, "ÄÖ é 日本語 İSTANBUL ΣΑΣ don't <|endoftext|> x"),
    (7, "word"),
    (8, " ".join(f"w{i % 97}x{i // 97}" for i in range(6000))),
    (9, "One  TWO three\nfour five six seven eight nine ten"),
    (None, "a row without an id"),
]
