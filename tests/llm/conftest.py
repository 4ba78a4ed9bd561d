import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words int, _o string, root string, a string"

WORDS = "the quick brown fox jumps over a lazy dog near some river bank while many small birds sing their old songs".split()


def edge_rows():
    """Rows with NULLs in every column, empty and long texts, ties, repeated
    rows, a hot copy group, and columns whose names operators use themselves."""
    long = " ".join(WORDS[(i * i + i // 7) % len(WORDS)] + str(i % 91) for i in range(9000))
    copy = " ".join(WORDS * 3) + ".\nSecond line of text. password = 'Zx9kQ2mLp8Rt4Vw7'\n"
    rows = [(i, copy, "en", f"src{i % 3}", len(copy)) for i in range(10, 30)]
    rows += [
        (1, long, "en", "src0", len(long)), (2, long + " tail", "en", "src1", 1), (3, "", "en", "src1", 0),
        (4, None, "en", "src1", None), (None, copy, "de", None, 1), (None, None, None, None, None),
        (5, "   \n\t ", "fr", "src2", 6), (6, "one", "fr", "src2", 3), (6, "one", "fr", "src2", 3),
        (7, "two words", "fr", "src2", 9), (7, "other words", "fr", "src2", 9), (-8, copy.upper(), "en", "o/r", 1),
        (8, "a " * 300, "en", "src0", 600), (9, "Ünïcode ñandú 😀 中文　 text\u0085 x" * 9, "es", "src0", 5),
    ]
    return [(*r, 7, "o", "r", "A") for r in rows]


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA).repartition(4).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def duck():
    """Run oracle SQL over a list of rows as the documents table."""
    import duckdb
    import pandas as pd

    def run(sql, rows):
        con = duckdb.connect()
        frame = pd.DataFrame([r[:5] for r in rows], columns=["doc_id", "text", "lang", "source", "n_chars"])
        frame["doc_id"] = frame["doc_id"].astype("Int64")
        con.register("frame", frame)
        con.execute("CREATE VIEW documents AS SELECT doc_id::BIGINT AS doc_id, text::VARCHAR AS text, "
                    "lang::VARCHAR AS lang, source::VARCHAR AS source, n_chars::BIGINT AS n_chars FROM frame")
        cur = con.execute(sql)
        names = [d[0] for d in cur.description]
        return names, cur.fetchall()
    return run

