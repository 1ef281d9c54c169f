"""Upload lists and their alignment with uploads, worked out by hand, in both engines."""

import duckdb
import pytest

from stratafold.functions.dialect import DUCK, SPARK
from stratafold.plans.batch import aligned
from stratafold.plans.registry import with_

SAID = [
    (1, '[{"original_name":"a.pdf","相对路径":"x/a.pdf"}, 3, {"来源层":"库"}]'), (2, '{"来源类型":"网页","文件":[{"original_name":"b.pdf"}]}'), (3, "[1, 2]"), (4, "{broken"), (5, '{"文件":"none"}'), (6, '"text"'), (7, None), (8, '{"来源类型":"本地"}'),
]
UPLOADS = [(b, p, "" if p == 0 else f"own{p}.pdf") for b, _ in SAID for p in range(2)]
#: batch, place: shape, name, path, layers, described. The number in the first list does not count as a place.
WANT = {
    (1, 0): ("list", "a.pdf", "x/a.pdf", "", True), (1, 1): ("list", "own1.pdf", "", "库", True), (2, 0): ("object", "b.pdf", "", "", True), (2, 1): ("object", "own1.pdf", "", "", False),
    **{(b, p): (shape, "upload_0.pdf" if p == 0 else "own1.pdf", "", "", False) for b, shape in ((3, "list"), (4, "refused"), (5, "refused"), (6, "refused"), (7, "none"), (8, "object")) for p in range(2)},
}
LAST = "SELECT batch_id, place, shape, original_name, relative_path, layers, described FROM upl"


@pytest.mark.parametrize("engine", ["duck", "spark"])
def test_entries_and_uploads(spark, engine):
    if engine == "duck":
        db = duckdb.connect()
        db.execute("CREATE TABLE said_in (batch_id BIGINT, manifest VARCHAR); CREATE TABLE up_in (batch_id BIGINT, place INT, name VARCHAR)")
        db.executemany("INSERT INTO said_in VALUES (?, ?)", SAID)
        db.executemany("INSERT INTO up_in VALUES (?, ?, ?)", UPLOADS)
        rows = db.execute(with_(aligned(DUCK, "SELECT * FROM said_in", "SELECT * FROM up_in"), LAST)).fetchall()
    else:
        spark.createDataFrame(SAID, "batch_id long, manifest string").createOrReplaceTempView("said_in")
        spark.createDataFrame(UPLOADS, "batch_id long, place int, name string").createOrReplaceTempView("up_in")
        rows = [tuple(r) for r in spark.sql(with_(aligned(SPARK, "SELECT * FROM said_in", "SELECT * FROM up_in"), LAST)).collect()]
    assert {r[:2]: r[2:] for r in rows} == WANT
