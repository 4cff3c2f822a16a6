"""Rows that every operator must take, and where the small tables lie."""

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, TEXT string, n_words int, shard int"


def odd_rows():
    """Nulls, empties, spaces, ties, repeated rows, long texts and clashing extra columns."""
    words = [f"w{i % 700}x{i % 13}" for i in range(9000)]
    long = "\n".join(" ".join(words[i:i + 30]) for i in range(0, 9000, 30))
    same = "the same line in several documents\nand a second one\nTHE SAME line in several documents  "
    rows = [(0, same, "en", "b"), (1, same, "en", "b"), (1, same, "en", "b"), (2, None, None, None), (3, "", "en", "a"),
            (4, "  \n\t\x0b ", "en", None), (None, same + "\nmore", "en", "a"), (None, None, "fr", "a"),
            (5, long, "en", "b"), (6, long + " tail", "en", "c"), (7, "x" * 40_000, "en", "a"),
            (8, "é ñ ß ü 日本語。テキスト á \U0001F600 #*$%&|<>", "xx", "é"), (9, "one two", "en", "b"),
            (10, "# $ % " * 60, "en", "b"), (11, " ".join(["again and again"] * 40), "en", "a"),
            (12, "don't we'll \r\n\n  they've   12345 a1b2", "en", "z")]
    return [(i, t, la, s, None if t is None else len(t), "clash", 7, -1) for i, t, la, s in rows]
