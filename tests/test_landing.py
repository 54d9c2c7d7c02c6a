import datetime as dt
import os

import pytest

from carestar.plans import control, load
from carestar.schemas import ENTITIES
from carestar.sources.csv import UnexpectedColumns, look_through, open_extract, read_entity_csv
from carestar.sources.landing import LandingZone, load_entity, results_frame, run_extract, summary

ENTITY = ENTITIES["payer_transitions"]
HEADER = "PATIENT,START_YEAR,END_YEAR,PAYER,OWNERSHIP"


@pytest.fixture
def zone(spark, folder):
    return LandingZone(spark, f"{folder}/landing")


@pytest.fixture
def files(tmp_path):
    def write(name, *lines):
        path = tmp_path / name
        path.write_text("\n".join(lines) + "\n", encoding="utf-8")
        return str(path)

    return write


def landed(zone):
    return sorted(tuple(r) for r in zone.read(ENTITY).select("PATIENT", "OWNERSHIP", "batch_id").collect())


def test_text_stays_text(spark, files):
    path = files("a.csv", HEADER, 'p1,1999,,NA,"say ""hi"", you"', " p2 ,,null,\"\",ü")
    rows = read_entity_csv(spark, ENTITY, path).collect()
    assert [tuple(r) for r in rows] == [
        ("p1", "1999", "", "NA", 'say "hi", you'), (" p2 ", "", "null", "", "ü"),
    ]


def test_columns_go_by_name(spark, files):
    path = files("a.csv", "payer,PATIENT", "y,p")
    row = read_entity_csv(spark, ENTITY, path).first()
    assert (row.PAYER, row.PATIENT, row.OWNERSHIP) == ("y", "p", None)
    with pytest.raises(UnexpectedColumns):
        read_entity_csv(spark, ENTITY, files("b.csv", HEADER + ",EXTRA", "a,b,c,d,e,f"))


def test_line_breaks_in_cells(spark, files):
    path = files("a.csv", HEADER, '"p\r\n1",1999,,y,o')
    assert read_entity_csv(spark, ENTITY, path, multiline=True).first().PATIENT == "p\r\n1"


def test_change_policies(spark, zone, files):
    first = files("a.csv", HEADER, "p1,1,2,y,A", "p2,1,2,y,A")
    result = load_entity(zone, ENTITY, first, "b1", now=dt.datetime(2024, 1, 1))
    assert (result.status, result.rows_loaded, result.table_name) == (
        "SUCCESS", 2, "Landing_Payer_Transitions",
    )
    assert load_entity(zone, ENTITY, first, "b2").status == "SKIP"
    changed = files("b.csv", HEADER, "p1,1,2,y,B", "p2,1,2,y,A")
    assert load_entity(zone, ENTITY, changed, "b2").status == "SKIP"
    assert load_entity(zone, ENTITY, first, "b2", policy="fingerprint").status == "SKIP"
    assert load_entity(zone, ENTITY, changed, "b2", policy="fingerprint").status == "SUCCESS"
    assert landed(zone) == [("p1", "A", "b1"), ("p1", "B", "b2"), ("p2", "A", "b1"), ("p2", "A", "b2")]
    # The same batch again replaces its own rows only.
    shorter = files("c.csv", HEADER, "p9,1,2,y,C")
    assert load_entity(zone, ENTITY, shorter, "b2").status == "SUCCESS"
    assert landed(zone) == [("p1", "A", "b1"), ("p2", "A", "b1"), ("p9", "C", "b2")]
    assert zone.read(ENTITY, ["b2"]).count() == 1
    failed = load_entity(zone, ENTITY, first, "b3", policy="other")
    assert failed.status == "FAILED" and "policy" in failed.error


def test_one_failure_does_not_stop_the_others(spark, zone, store, files, tmp_path):
    for entity in ENTITIES.values():
        if entity.name != "payers":
            files(entity.csv, ",".join(entity.column_names), "k" + "," * (len(entity.columns) - 1))
    results = load.extract(zone, store, str(tmp_path), "batch")
    status = {r.table_name: r.status for r in results}
    assert status.pop("Landing_Payers") == "FAILED" and set(status.values()) == {"SUCCESS"}
    rows = {r.status: r for r in summary(results_frame(spark, results)).collect()}
    assert (rows["SUCCESS"].n_tables, rows["SUCCESS"].total_rows) == (7, 7)
    assert (rows["FAILED"].n_tables, rows["FAILED"].total_rows) == (1, 0)
    marks = {r.table_name: r for r in store.read(control.WATERMARKS).collect()}
    assert len(marks) == 8 and marks["Landing_Payers"].last_batch_id is None
    assert marks["Landing_Payers"].last_loaded_at == control.NEVER
    assert marks["Landing_Patients"].rows_loaded == 1
    log = store.read(control.RUN_LOG).first()
    assert (log.proc_name, log.status, log.rows_affected) == (load.EXTRACT, "FAILED", 7)
    assert [r.status for r in run_extract(zone, str(tmp_path), "next")].count("SKIP") == 7
    assert os.path.exists(tmp_path)


def test_watermark_upsert(spark):
    held = control.seeded_watermarks(spark, None)
    assert held.count() == 8 and control.seeded_watermarks(spark, held).count() == 8
    news = spark.sql(
        "SELECT 'Landing_Payers' AS table_name, 'b' AS last_batch_id, "
        "TIMESTAMP_NTZ '2024-01-01' AS last_loaded_at, 5L AS rows_loaded"
    )
    rows = {r.table_name: r for r in control.updated_watermarks(held, news).collect()}
    assert len(rows) == 8 and rows["Landing_Payers"].rows_loaded == 5


def test_line_breaks_in_cells_land_whole_by_default(spark, files, tmp_path):
    path = files("a.csv", HEADER, '"p\n1",1999,,y,o', "p2,1999,,y,o")
    zone = LandingZone(spark, str(tmp_path / "zone"))
    result = load_entity(zone, ENTITY, path)
    assert (result.status, result.rows_loaded) == ("SUCCESS", 2)
    assert {r.PATIENT for r in zone.read(ENTITY).collect()} == {"p\n1", "p2"}


def test_single_lines_fail_on_a_cut_row(spark, files, tmp_path):
    zone = LandingZone(spark, str(tmp_path / "zone"))
    broken = files("a.csv", HEADER, '"p\n1",1999,,y,o', "p2,1999,,y,o")
    result = load_entity(zone, ENTITY, broken, multiline=False)
    assert result.status == "FAILED" and "MALFORMED" in result.error.upper()
    assert zone.read(ENTITY).count() == 0
    whole = files("b.csv", HEADER, "p1,1999,,y,o", "p2,1999,,y,o")
    assert load_entity(zone, ENTITY, whole, multiline=False).rows_loaded == 2


def test_a_clean_extract_of_parts_is_split(spark, files, tmp_path):
    parts = tmp_path / "extract.csv"
    parts.mkdir()
    for k in range(3):
        lines = [f'p{k}-{n},1999,,"y ""{n}""",o' for n in range(50)]
        (parts / f"part {k}%.csv").write_text("\n".join([HEADER, *lines]) + "\n")
    rows = read_entity_csv(spark, ENTITY, str(parts))
    assert rows.rdd.getNumPartitions() >= 3
    assert rows.count() == 150 and rows.select("PATIENT").distinct().count() == 150
    assert open_extract(spark, ENTITY, str(parts)).uncounted is None
    zone = LandingZone(spark, str(tmp_path / "zone"))
    assert load_entity(zone, ENTITY, str(parts)).rows_loaded == 150
    assert load_entity(zone, ENTITY, str(parts)).status == "SKIP"


def test_one_large_file_is_split(spark, files):
    path = files("a.csv", HEADER, *[f"p{n},1999,,y,o" for n in range(4000)])
    held = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for k in held:
            spark.conf.set(k, "8k")
        extract = open_extract(spark, ENTITY, path)
        assert extract.rows.rdd.getNumPartitions() >= 3
        assert extract.count() == extract.rows.count() == 4000
    finally:
        for k, value in held.items():
            spark.conf.set(k, value)


def test_only_files_with_breaks_in_cells_are_read_whole(spark, tmp_path):
    parts = tmp_path / "extract"
    parts.mkdir()
    # A cut row can have all cells on each of its lines; quotes tell.
    broken = 'p0,1999,,y,"first\na,b,c,d,last"\n\np1,1999,,y,"a ""b"" c"\n'
    (parts / "a.csv").write_text(HEADER + "\n" + broken)
    (parts / "b.csv").write_text(HEADER + '\n"p2",1999,,y,"x, ""y"""\n')
    assert [f.rows for f in look_through(spark, str(parts))] == [None, 1]
    extract = open_extract(spark, ENTITY, str(parts))
    got = sorted((r.PATIENT, r.OWNERSHIP) for r in extract.rows.collect())
    assert got == [("p0", "first\na,b,c,d,last"), ("p1", 'a "b" c'), ("p2", 'x, "y"')]
    assert extract.count() == 3


def test_parts_with_other_headers_fail(spark, tmp_path):
    parts = tmp_path / "extract"
    parts.mkdir()
    (parts / "a.csv").write_text(HEADER + "\np0,1999,,y,o\n")
    (parts / "b.csv").write_text("OWNERSHIP,PAYER,END_YEAR,START_YEAR,PATIENT\no,y,,1999,p1\n")
    zone = LandingZone(spark, str(tmp_path / "zone"))
    assert load_entity(zone, ENTITY, str(parts)).status == "FAILED"
    assert zone.read(ENTITY).count() == 0


def test_empty_files_and_headers_alone(spark, files):
    assert read_entity_csv(spark, ENTITY, files("a.csv")).collect() == []
    extract = open_extract(spark, ENTITY, files("b.csv", HEADER))
    assert extract.count() == 0 and extract.rows.collect() == []
    assert extract.rows.columns == ENTITY.column_names
