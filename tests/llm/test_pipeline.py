import __spark_entry__ as driver
import corpus_pipeline
import numpy as np
from pyspark.sql import functions as F

from carestar.llm.common import stored
from carestar.llm.decontam import GAP, MATCH, MISMATCH, needed_score
from carestar.llm.secrets import scan
from tests.llm.cases import edge_rows, frame, prose
from tests.llm.test_decontam import brute_alignment
from tests.llm.test_neardup import brute_classes
from tests.llm.test_packing import check
from tests.llm.test_quality import brute

SMALL = "/root/testdata/sf0.001"


def rows_of(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_stages_by_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    steps = [rows_of(docs)]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, SMALL), name)
        assert docs.columns == columns
        steps.append(rows_of(docs))
    start, good, single, clean, masked = steps
    # Quality: the base rule holds, and labelled documents are judged as they are labelled.
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    kept = {i for i, _ in good}
    for i, text in start:
        n, *_, repeated = brute(text)
        if n < 20 or 100 * repeated > 30 * n:
            assert i not in kept
    judged = [(i in kept) == bool(labels[i]) for i, t in start if i in labels and brute(t)[0] >= 20]
    assert np.mean(judged) > 0.9
    # Near duplicates: the smallest id of each class of all pairs.
    smallest: dict[int, int] = {}
    for (i, _), c in zip(good, brute_classes(good), strict=True):
        smallest[c] = min(i, smallest.get(c, i))
    assert sorted(smallest.values()) == sorted(i for i, _ in single)
    # Leaks: every document aligned with every item.
    items = [r.text for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    plain = lambda t: [w for x in t.lower().split() if (w := "".join(c for c in x if c.isalnum()))]
    leaks = set()
    for i, text in single:
        words = plain(text)
        for item in map(plain, items):
            if len(set(item) & set(words)) * MATCH >= needed_score(len(item), 0.5):
                if len(words) < 400 and brute_alignment(words, item) >= needed_score(len(item), 0.5):
                    leaks.add(i)
                elif " ".join(item) in " ".join(words):
                    leaks.add(i)
    assert {i for i, _ in single} - {i for i, _ in clean} == leaks
    assert (GAP, MISMATCH) == (-1, -1)
    # Secrets: none is left, nothing else changes, lengths follow.
    before = dict(clean)
    assert {i for i, _ in masked} == set(before)
    for i, text in masked:
        assert not scan(text)[1] and (text == before[i]) == (not scan(before[i])[1])
    assert docs.where(F.length("text") != F.col("n_chars")).count() == 0
    # Packing: every id of what is left, once.
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).collect()
    check(masked, packed, 4096)


def test_odd_rows_pass_all_stages(spark):
    docs = frame(spark, [*edge_rows(), (30, "token = abcdefghijklmnop " + "word " * 30)])
    docs = docs.withColumn("n_chars", F.length("text").cast("long"))
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, SMALL), name)
        assert docs.columns == columns
    assert {r.doc_id for r in docs.collect()} >= {1, 6}
    none = docs.where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, SMALL).collect() == []


CLASHES = ["__h", "__at", "__word", "__likely", "__id", "__mark", "__stays", "__masked", "___id", "a.b", "of", "first", "rows"]


def test_columns_of_any_name_come_through(spark):
    rows = [(1, prose(1, 60)), (2, prose(1, 60)), (3, prose(2, 60)), (3, prose(2, 60)), (4, None), (5, "token=" + "k1" * 9)]
    docs = frame(spark, rows)
    docs = docs.select("doc_id", "text", *(F.concat(F.lit(f"{c} of "), "doc_id").alias(c) for c in CLASHES))
    stages = dict(corpus_pipeline.STAGES)
    for name, kept in (("near_duplicates", [1, 3, 4, 5]), ("decontamination", [1, 3, 4, 5]), ("secret_scans", [1, 3, 4, 5])):
        docs = stored(stages[name](spark, docs, SMALL), name)
        assert docs.columns == ["doc_id", "text", *CLASHES]
        got = sorted(docs.collect())
        assert [r.doc_id for r in got] == kept
        assert all(r[c] == f"{c} of {r.doc_id}" for r in got for c in CLASHES)
    assert got[-1].text == "[SECRET]"


def test_all_are_registered():
    names = list(driver.queries())
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert "pipeline" in names
    assert len(corpus_pipeline.STAGES) == 5
    assert "op1_quotation_linking" in driver.oracle_sql()
