"""Edge rows shared by the tests: (doc_id, text, source)."""

PASSAGE = " ".join(f"word{i}" for i in range(60))
EDGES = [
    (1, "start " + PASSAGE + " end", "a"), (2, None, "a"), (3, "", "b"), (4, " \t\n ", None), (None, "no id " + PASSAGE, "b"),
    (5, PASSAGE, "a"), (6, PASSAGE.replace(" ", "\n\n"), "a"), (6, PASSAGE.replace(" ", "\n\n"), "a"), (7, "Ünïcode 中文 " * 30, "c"),
    (8, "same " * 100, "c"), (9, "same " * 100, None), (10, "x" * 50_000, "c"), (11, "long text here " * 20_000, "a"), (12, "one", "b"),
]
SF001 = "/root/testdata/sf0.001"
