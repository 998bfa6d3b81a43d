import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def made_rows(n=120, seed=3):
    """Documents with copies, near copies, empty and null texts, ties, nulls and one source that holds most rows."""
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 7))) for _ in range(400)]
    rows, passage = [], " ".join(rng.choice(words) for _ in range(60))
    for i in range(n):
        text = " ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 3, 4, 5, 30, 120])))
        if i % 9 == 3 and rows:
            text = rows[rng.randrange(len(rows))][1]
        if i % 9 == 5:
            text = f"{text}\n{passage}  {text[:40]}"
        if i % 11 == 6 and rows and rows[-1][1]:
            near = rows[-1][1].split(" ")
            near[len(near) // 2] = "other"
            text = " ".join(near)
        rows.append((i, text, rng.choice(["en", "de", None]), rng.choice(["a", "a", "a", "b", "c", None]), len(text or "")))
    rows += [(n, None, None, None, None), (n + 1, "", "en", "z", 0), (n + 2, " \t\n ", "en", "a", 4), (n + 3, "long " * 30000, "en", "a", 150000)]
    return rows


@pytest.fixture(scope="session")
def rows():
    return made_rows()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture
def table(spark, tmp_path):
    """Writes documents and other tables where a query reads them; gives the folder."""

    def write(docs, **others):
        docs.coalesce(2).write.parquet(str(tmp_path / "documents.parquet"))
        for k, v in others.items():
            v.write.parquet(str(tmp_path / f"{k}.parquet"))
        return str(tmp_path)

    return write
