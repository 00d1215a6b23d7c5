"""Stages of the pipeline on documents with further columns of many types."""

import weakref

import pyarrow as pa

import corpus_pipeline
from tidematch.llm import common, langid

EXTRA = {
    "a_date": "date'2024-02-29'",
    "a_time": "timestamp'2024-02-29 01:02:03.456789'",
    "a_local": "timestamp_ntz'2024-02-29 01:02:03'",
    "a_decimal": "cast(1.25 as decimal(20, 4))",
    "a_small": "cast(7 as smallint)",
    "a_map": "map('a', array(1, 2), 'b', null)",
    "a_nested": "named_struct('x', named_struct('y,z', array(named_struct('d', date'2024-01-01'))))",
    "a_null": "cast(null as decimal(5, 1))",
    "a_tiny": "cast(1 as tinyint)",
}


def texts():
    words = {"en": "the house and a garden of my friend", "de": "das haus und der garten von meinem freund"}
    return [(lang, f"{words[lang]} {' '.join(f'{c}{i}' for c in words[lang].split())}") for i in range(12) for lang in words]


def test_other_columns_keep_their_types_and_values(spark, make_docs):
    rows = texts()
    docs = make_docs([t for _, t in rows], langs=[lang for lang, _ in rows])
    docs = docs.selectExpr("*", *[f"{e} AS {n}" for n, e in EXTRA.items()])
    extra = [n for n in EXTRA]
    wanted = docs.select(*extra).first()
    for name, stage in corpus_pipeline.STAGES[:3:2]:
        after = stage(spark, docs, "")
        assert after.dtypes == docs.dtypes
        found = after.select(*extra).collect()
        assert found and all(r == wanted for r in found), name
    assert langid.with_language(docs, langid.train(docs), "p", "s").count() == len(rows)


class Frame:
    """A table that hands over the function for its batches."""

    def __init__(self, df):
        self.sparkSession, self.schema, self.columns = df.sparkSession, df.schema, df.columns

    def mapInArrow(self, run, schema):
        return run


def test_operators_get_small_batches_and_keep_none(spark, make_docs, monkeypatch):
    """Spark's batches are bounded, and one is gone before the next comes."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    docs = make_docs(["a"]).select("doc_id", "text")
    make = lambda: lambda columns: [(1,) for _ in columns[0]]
    try:
        spark.conf.set(name, "10000")
        runs = [common.map_batches(Frame(docs), make, "n long")]
        assert int(spark.conf.get(name)) == common.ROWS_IN
        runs.append(common.with_columns_of(Frame(docs), "text", lambda: lambda texts: [(1,) for _ in texts], "n long"))
        spark.conf.set(name, "7")
        common.map_batches(Frame(docs), make, "n long")
        assert spark.conf.get(name) == "7"
        spark.conf.set(name, "0")  # no bound
        sizes = common.map_batches(
            spark.range(0, 5000, 1, 1).selectExpr("id AS doc_id"), lambda: lambda columns: [(len(columns[0]),)], "n long"
        )
        assert sum(r["n"] for r in sizes.collect()) == 5000
        assert int(spark.conf.get(name)) == common.ROWS_IN
    finally:
        spark.conf.set(name, before)

    def noted(seen):
        batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "text": ["a", "b"]})
        seen.append(weakref.ref(batch))
        return batch

    def batches(seen):
        for _ in range(3):
            assert all(old() is None for old in seen)
            yield noted(seen)

    for run in runs:
        assert sum(b.num_rows for b in run(batches([]))) == 6
