from __future__ import annotations

import corpus_pipeline
from shelfcast.llm import decontaminate, line_dedup, pieces, quality, simhash
from shelfcast.llm.common import read, stage

SF = "/root/testdata/sf0.001"


def ids(frame):
    return sorted(r.doc_id for r in frame.select("doc_id").collect())


def test_each_stage_does_what_its_operator_says(spark):
    docs = read(spark, SF, "documents")
    columns, seen = docs.columns, {}
    for name, function in corpus_pipeline.STAGES:
        before, docs = docs, stage(function(spark, docs, SF), "test")
        seen[name] = (before, docs)
        assert docs.columns == columns or name == "SentencePiece encoding"
        assert docs.count() == docs.select("doc_id").distinct().count()

    before, after = seen["quality rules"]
    assert ids(after) == ids(quality.judge(before).where("kept")) and 0 < after.count() < before.count()
    assert after.exceptAll(before).count() == 0

    before, after = seen["line dedup"]
    kept = {}
    for r in sorted(line_dedup.report(before).collect(), key=lambda r: (r.doc_id, r.line_no)):
        kept.setdefault(r.doc_id, {})[r.line_no] = r.kept
    texts = {}
    for r in before.collect():
        lines = [x for i, x in enumerate(r.text.split("\n")) if kept.get(r.doc_id, {}).get(i, True)]
        if any(kept.get(r.doc_id, {0: True}).values()):
            texts[r.doc_id] = "\n".join(lines)
    assert {r.doc_id: r.text for r in after.collect()} == texts

    before, after = seen["SimHash near-dedup"]
    assert ids(after) == sorted({r.component_id for r in simhash.near_duplicates(before).collect()})

    before, after = seen["benchmark decontamination"]
    bad = set(ids(decontaminate.leaks(before, read(spark, SF, "benchmark"))))
    assert ids(after) == sorted(set(ids(before)) - bad)

    before, after = seen["SentencePiece encoding"]
    model = f"{corpus_pipeline.TOKENIZERS}/piece_bpe_32k.model"
    assert {r.doc_id: r.text for r in pieces.decode(after, model).collect()} == {r.doc_id: r.text for r in before.collect()}


def test_run_gives_the_last_stage(spark):
    rows = corpus_pipeline.run(spark, SF)
    assert rows.count() > 0 and rows.where("NOT round_trip OR n_tokens <> size(ids)").count() == 0


def test_odd_rows_and_columns_pass_through_all_stages(spark):
    """Nulls in any column, empty, repeated and very long texts, columns with the names that operators use, no rows."""
    docs, bench = read(spark, SF, "documents"), read(spark, SF, "benchmark")
    long = " ".join(f"w{i}" for i in range(60_000)) + "\n" + "7," * 10_000 + " " * 100_000 + "end"
    odd = [
        (None, "Some words of a text that nobody has an id for, and a few more words to fill it.", "en", "a", 5),
        (900_001, None, None, None, None),
        (900_002, "", "en", None, 0),
        (900_003, " \n\t\n ", None, "b", 5),
        (900_004, long, "en", "a", len(long)),
        (900_005, "one", "xx", "a", 3),
    ]
    more = spark.createDataFrame(odd, docs.schema)
    table = docs.limit(60).unionByName(more).unionByName(more.where("doc_id = 900004"))
    clashing = ["item_id", "id", "th", "hash", "kept", "at", "key", "words", "gone", "_m", "component_id", "fingerprint", "windows", "ids"]
    table = stage(table.selectExpr("*", *(f"doc_id AS `{name}`" for name in clashing)), "test")
    left = table
    for name, function in corpus_pipeline.STAGES[:-1]:
        left = stage(function(spark, left, SF), "test")
        assert left.dtypes == table.dtypes, name
        assert left.count() > 0
    found = [r.doc_id for r in left.collect()]
    assert found.count(900_004) == 1 and not {900_001, 900_002, 900_003, 900_005} & set(found) and None in found
    last = corpus_pipeline.STAGES[-1][1](spark, left, SF)
    assert last.count() == left.count() and last.where("NOT round_trip").count() == 0
    empty = table.where("false")
    for name, function in corpus_pipeline.STAGES:
        assert function(spark, empty, SF).collect() == [], name
    assert bench.count() > 0
