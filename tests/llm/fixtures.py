"""Small tables with the awkward cases of real ones."""

import duckdb

SF = "/root/testdata/sf0.001"

AWKWARD = [None, "", " \n\t ", "a", "A b", "a b c d", "\n\nx\n", "é\x85b \x1c x", "12 34", "日本語 テキスト",
           "<|endoftext|> is text", "word " * 3000, "x" * 5000, "same words here again\n" * 40, "same words here again\n" * 40]


def documents(n=200):
    """(doc_id, text, lang, source, n_chars) rows: the smallest table, awkward
    texts, an exact repeat of a row, and a null id."""
    rows = duckdb.sql(f"SELECT doc_id, text, lang, source, n_chars FROM '{SF}/documents.parquet' ORDER BY doc_id LIMIT {n}").fetchall()
    rows += [(10_000 + i, t, None if i % 3 else "en", None, len(t or "")) for i, t in enumerate(AWKWARD)]
    return rows + [rows[0], (None, rows[1][1], None, "src0", 1)]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars int"


def frame(spark, rows=None, parts=3):
    return spark.createDataFrame(documents() if rows is None else rows, SCHEMA).repartition(parts)


def clashing(df):
    """With columns whose names the operators use themselves."""
    from pyspark.sql import functions as F
    return df.withColumns({n: F.lit("own") for n in ("hits", "fp", "kept", "raw", "kept_id", "kept_hash", "spans",
                                                      "sequence_id", "label", "key", "part")})


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)
