"""Rows that every operator must bear: nulls, empty and long texts, repeats, clashing columns."""

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "score double, fingerprint string, component_id long, key_0 string, start long, "
          "file string, term string, stratum string, kept boolean, words string, range int")
WORDS = "the of and to in a is that it was for on are with as his they at be this".split()


def prose(seed: int, n: int) -> str:
    """``n`` words of repeatable prose."""
    state, out = seed * 7919 + 13, []
    for _ in range(n):
        state = (state * 1103515245 + 12345) % 2 ** 31
        out.append(WORDS[state // 65536 % len(WORDS)] + "xyzqkv"[state // 1024 % 6] * (state % 3))
    return " ".join(out)


def _row(doc_id, text, lang="en"):
    return (doc_id, text, lang, "src0", 1, 0.5, "f", 7, "k", 3, "file", "term", "s", True, "w", 1)


def odd_rows() -> list[tuple]:
    plain = prose(1, 60)
    return [_row(1, plain), _row(2, None), _row(3, ""), _row(4, " \n\t "), _row(5, plain, None),
            _row(None, prose(2, 40)), _row(6, "ab" * 4000), _row(7, prose(3, 9000)),
            _row(8, "!!! $$$ 123"), _row(9, plain), _row(9, plain), _row(9, prose(4, 30)),
            _row(10, "été  déjà vu\r\nœuvre 東京 𝔘𝔫𝔦"), _row(11, "a" * 300 + " b  c"),
            _row(None, None, None)] + [_row(20 + i, prose(20 + i, 50)) for i in range(20)]


def odd_documents(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)


def some_labels(spark, rows=None):
    """Labels with a null id, null values, a repeated id and a clashing column."""
    rows = rows if rows is not None else (
        [(None, 1, 0, "x"), (1, None, None, "x"), (9, 1, 1, "x"), (9, 0, 0, "x")]
        + [(20 + i, i % 2, i % 3 == 0 and 1 or 0, "x") for i in range(20)])
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int, text string")
