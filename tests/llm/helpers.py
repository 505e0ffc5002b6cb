"""Small documents with the awkward cases, under a schema with extra and clashing columns."""

EXTRA = "doc_id long, text string, lang string, source string, n_chars long, tokens string, component long, key string, id string"


def docs(spark, texts, parts=3):
    rows = [(i, t, "en" if (i or 0) % 2 else None, f"src{(i or 0) % 4}" if (i or 0) % 5 else None, len(t or ""), "x", 1, "k", "i") for i, t in texts]
    return spark.createDataFrame(rows, EXTRA).repartition(parts)


LONG = " ".join(f"word{i % 997} the of line{i}" for i in range(30_000))
AWKWARD = [(1, None), (2, ""), (3, "   \n\t "), (4, "one"), (5, "the of and"), (6, "Ünïcödé 🙂 text with the of marks"), (7, LONG), (8, LONG), (8, LONG), (-3, "a\nb\nc"), (2**55 + 1, "big id"), (None, "no id")]
