"""The queries against their SQL on awkward documents: nulls, empty, cut characters, copies, very long texts."""
import random

import pytest

from rttlab.llm import queries

random.seed(31)
LONG = " ".join(random.choices(["alpha", "beta", "gämma", "δ", "e."], k=6_000))
PASSAGE = " ".join(f"w{i}" for i in range(90))
BASE = "".join(random.choices("abcdé ", k=900))
TEXTS = [None, "", " \t\n", "one", "A b c", "a  b\tc", PASSAGE, "x y " + PASSAGE + " z", PASSAGE + " tail", LONG, "l1\nl1\nl2 é\n\nl1", "same text",
         "same text", "same  text", "é" * 700, "ab" * 500, "ü" + BASE[:500] + "ö", "€" + BASE[100:600] + "日", "日" + BASE[:500] + "本", "#*$%&|<>" * 9,
         "Ends\r\n", "one line again and again\n" * 30]
TEXTS += ["é" + "ÄÖ" * 250 + x for x in "ab"] + ["".join(random.choices(["éa", "éb"], k=400)) for _ in range(3)] * 2
LANGS, SOURCES = ["en", None, "de", "é"], ["s1", "s0", None, "S", "é"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    at = tmp_path_factory.mktemp("sql")
    rows = [(7 * i, t, LANGS[i * i % 4], SOURCES[i % 5], None if i % 6 == 0 else i, "clash") for i, t in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, kept string")
    docs.repartition(4).write.parquet(str(at / "documents.parquet"))
    spark.createDataFrame([(1, "beta gämma"), (2, None), (3, "w1 w2")], "item_id long, text string").write.parquet(str(at / "benchmark.parquet"))
    return str(at)


@pytest.mark.parametrize("name", [n for n in queries.ORACLE if n.split("_")[0] in ("op1", "op6", "op7", "op9", "op11", "op12", "op13")])
def test_query_equals_its_sql(spark, folder, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"create view {t} as select * from read_parquet('{folder}/{t}.parquet/*.parquet')")
    want = con.sql(queries.ORACLE[name])
    names = sorted(want.columns)
    got = queries.QUERIES[name](spark, folder)
    assert sorted(got.columns) == names
    rows = lambda rs, cs: sorted((tuple(r[cs.index(n)] for n in names) for r in rs), key=str)
    a, b = rows([tuple(r) for r in got.collect()], got.columns), rows(want.fetchall(), want.columns)
    assert len(a) == len(b) == len(TEXTS)
    for x, y in zip(a, b):
        assert x == y or all(u == v or (isinstance(u, float) and abs(u - v) < 1e-9) for u, v in zip(x, y))
