"""Small tables with the awkward cases that every operator must define."""

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(seed: int, n: int, vocabulary: int = 400) -> list[str]:
    out, x = [], seed * 7919 + 13
    for _ in range(n):
        x = (x * 1103515245 + 12345) % (1 << 31)
        out.append(f"w{x // 65536 % vocabulary}")
    return out


def text(seed: int, n: int, per_line: int = 9) -> str:
    w = words(seed, n)
    return "\n".join(" ".join(w[i:i + per_line]) for i in range(0, n, per_line))


def awkward_rows() -> list[tuple]:
    """Nulls, empty and very long texts, copies, near copies, repeated rows,
    shared passages, odd characters."""
    passage = text(99, 60)
    near = text(5, 120).split(" ")
    near[30] = "changed"
    rows = [
        (1, text(1, 80)), (2, text(1, 80)), (3, text(3, 50) + "\n" + passage), (4, passage + "\n" + text(4, 70)),
        (5, text(5, 120)), (6, " ".join(near)), (7, None), (8, ""), (9, "   \n\n \t"), (10, "one two three"),
        (11, "Ünïcödé ñandú 日本語 テキスト \x00 nul \x1c sep <|endoftext|> İΣ"), (12, text(12, 30_000)), (13, "a" * 5000),
        (14, "!!! ??? ... ***"), (15, "same same " * 40), (16, text(16, 60)), (16, text(16, 60)), (17, text(1, 80)),
        (None, text(18, 40)), (None, None), (19, "x@y.example.com +1 (269) 555-3296 " + text(19, 40)),
        (20, "call +1 269 555 3296 or X@Y.EXAMPLE.COM " + text(20, 40)),
    ]
    return [(i, t, None if i == 3 else "en", None if i == 4 else "s", len(t or "")) for i, t in rows]


def awkward(spark):
    return spark.createDataFrame(awkward_rows(), DOC_SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], DOC_SCHEMA)
