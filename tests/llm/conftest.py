import tempfile

import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text) pairs, with columns whose names the operators also use."""

    def build(rows, **more):
        ddl = "doc_id long, text string, lang string, source string, n_chars long, h long, row_hash long, n long, bucket string"
        full = [(i, t, None, f"s{(i or 0) % 3}", len(t or ""), 1, 2, 3, "x") for i, t in rows]
        return spark.createDataFrame(full, ddl)

    return build


@pytest.fixture
def written(docs):
    """The same as a parquet folder, one file per part."""

    def build(rows, parts=1):
        folder = tempfile.mkdtemp(prefix="recprep-docs-") + "/documents.parquet"
        docs(rows).repartition(parts).write.parquet(folder)
        return folder

    return build


def by_id(df, *columns):
    return {r["doc_id"]: tuple(r[c] for c in columns) if len(columns) > 1 else r[columns[0]] for r in df.collect()}
