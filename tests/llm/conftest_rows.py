"""Rows with nulls in every column, empty and long texts, ties and repeats."""

LOREM = " ".join(f"alpha{i} beta{i % 7} gamma{i % 11}" for i in range(60))
LONG = " ".join(f"w{i % 5003}x{i % 17}" for i in range(60_000))


def awkward_rows():
    return [
        (1, LOREM, "en", "a", len(LOREM)), (1, LOREM, "en", "a", len(LOREM)),
        (2, LOREM.upper(), None, None, None), (None, LOREM + " tail", "en", "b", 3),
        (3, None, None, "a", None), (4, "", "en", None, 0), (5, " \t\n ", "en", "c", 4),
        (6, LONG, "en", "a", len(LONG)), (7, "one", "en", "a", 3), (None, None, None, None, None),
        (8, "É é ß 漢字 \U0001d4b3 mit license", "fr", "b", 5),
    ]
