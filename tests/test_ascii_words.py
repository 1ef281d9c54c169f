"""Registered queries cut words where their SQL does, also beside umlauts; a parse of one's own pages follows Unicode."""

import duckdb
import pytest

from stratafold.functions.dialect import DUCK, REGISTERED, SPARK
from stratafold.plans import all_queries, all_sql

#: A line in which a rule finds a word before an umlaut; hint words that an umlaut follows, and odd blanks.
LINE = 'Undßöber. Zukeitau und mit der diegeeinüte enkeitkeit die eine eneinkeitkeit dieerzuungä autzge in gezuber üäch pfberach einenlich geheitß die dem im die schö enätesch zuch erstie schgeen der erschlichbe einieie in schchung dieberietz für die der enchst chber öie auieß schverä ertzung geeintz einach beiepf tzstzu diechbeschsch engeschge und üöung chein erlichsch. Te lichzuung schsch erauheitge eröie cheinau die das zu ungcher dem erie und dem das berie das.'
TEXTS = ("the and for undß undß undß mitö", "the\x0band for the undß\x85und\u2003mit", "SS enpfgebe, be entzkeit einlichung chüpf.\n" + LINE)


@pytest.mark.parametrize("name", ["a06_language", "s14_parsed_texts"])
def test_words_beside_umlauts(spark, tmp_path, name):
    spark.createDataFrame([(i, t, "de", "web") for i, t in enumerate(TEXTS)], "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    duck = duckdb.connect()
    duck.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    want = duck.execute(all_sql()[name])
    columns, rows = [c[0] for c in want.description], want.fetchall()
    assert sorted(map(tuple, all_queries()[name](spark, str(tmp_path)).select(*columns).collect()), key=str) == sorted(rows, key=str)


def test_dialects_differ_beside_umlauts(spark):
    found = lambda d: f"SELECT {d.search(d.lit('undß'), r'\bund\b')} AS x"
    assert duckdb.connect().execute(found(DUCK)).fetchone()[0] and spark.sql(found(REGISTERED)).first().x
    assert not spark.sql(found(SPARK)).first().x
