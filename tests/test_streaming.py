import datetime as dt

import pytest
from pyspark.errors import StreamingQueryException

from carestar.schemas import ENTITIES
from carestar.streaming.files import stream_to_staging

ENTITY = ENTITIES["payer_transitions"]
HEADER = "PATIENT,START_YEAR,END_YEAR,PAYER,OWNERSHIP\n"


def test_new_files_are_staged_once(store, folder, tmp_path):
    def run(now):
        stream_to_staging(
            store, ENTITY, str(tmp_path), f"{folder}/checkpoint", now=now
        ).awaitTermination()
        return sorted(
            (r.PATIENT, r.START_YEAR, r.OWNERSHIP, r.update_at)
            for r in store.read(ENTITY.staging_table).collect()
        )

    t1, t2, t3 = (dt.datetime(2024, 1, day) for day in (1, 2, 3))
    (tmp_path / "a.csv").write_text(HEADER + "p1,1999,,y,A\n ,1999,,y,A\n")
    assert run(t1) == [("p1", 1999, "A", t1)]
    assert run(t2) == [("p1", 1999, "A", t1)]
    (tmp_path / "b.csv").write_text(HEADER + "p1,1999,,y,B\np2,x,,y,C\n")
    result = run(t3)
    assert [(r[0], r[2], r[3]) for r in result] == [("p1", "B", t3), ("p2", "C", t3)]


def test_a_file_with_another_header_fails_the_run(store, folder, tmp_path):
    def run():
        stream_to_staging(store, ENTITY, str(tmp_path), f"{folder}/checkpoint").awaitTermination()

    (tmp_path / "a.csv").write_text(HEADER + 'p1,1999,,y,"A\nB"\n')
    run()
    other = ",".join(HEADER.strip().split(",")[::-1])
    (tmp_path / "b.csv").write_text(f"{other}\nA,y,,1999,p2\n")
    with pytest.raises(StreamingQueryException):
        run()
    assert [(r.PATIENT, r.OWNERSHIP) for r in store.read(ENTITY.staging_table).collect()] == [("p1", "A\nB")]


def test_a_large_new_file_is_split_and_breaks_are_kept(spark, store, folder, tmp_path):
    from carestar.streaming.files import new_rows

    big = "".join(f"p{n},1999,,y,A\n" for n in range(3000))
    (tmp_path / "a b.csv").write_text(HEADER + big)
    (tmp_path / "c.csv").write_text(HEADER + 'q,1999,,y,"A\nB"\n')
    held = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for k in held:
            spark.conf.set(k, "8k")
        rows = new_rows(spark, ENTITY, [str(tmp_path / "a b.csv"), str(tmp_path / "c.csv")], None)
        assert rows.rdd.getNumPartitions() >= 4 and rows.count() == 3001
    finally:
        for k, value in held.items():
            spark.conf.set(k, value)
    stream_to_staging(store, ENTITY, str(tmp_path), f"{folder}/checkpoint", files_per_batch=1).awaitTermination()
    staged = store.read(ENTITY.staging_table)
    assert staged.count() == 3001
    assert [r.OWNERSHIP for r in staged.where("PATIENT = 'q'").collect()] == ["A\nB"]
