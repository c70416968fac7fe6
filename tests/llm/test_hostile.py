"""Every operator and stage over tables with clashing columns, nulls, repeated rows and ids, long texts, and no rows."""

import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from thermolake.llm import alignment, bitpack, ctw, decontaminate, hyperlang, linecrf, ngramjoin, sharding, suffixdedup, superminhash, telephony, wordbpe

NAMES = "good score spans block learns key kind bands members comp hit w sh media ids sub text_key part piece n pos begin end rank file nth feature pcm codec of first last center rep band cluster n_words n_hit items win size slot total value data held_out doc_id_ score_"
ITEM = " ".join(f"item{i}" for i in range(12))
PLAIN = "\n".join(f"This is line {i} of a plain text, which goes on for some words." for i in range(12))
ROWS = [
    (1, PLAIN), (1, PLAIN), (2, PLAIN + " tail"), (2, f"Other words of one id. {ITEM} here."), (2, None), (3, "BUY NOW!! #$% #$%"), (None, PLAIN), (None, None), (None, ITEM), (4, ""), (5, "   \n\t "), (6, "one"), (7, "ONE"),
    (8, " ".join(f"w{i % 7000}x{i % 911}" for i in range(500_000))), (9, "x" * 100_000), (10, "é 中文 😀 \x00"), (11, "a՘b ౜ Ᲊ Ꟛ ʯ𞤢"),
]
PATH = wordbpe.vocabulary_path()


def table(spark, rows):
    df = spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars int")
    return df.select("*", *[F.lit("?").alias(c) for c in NAMES.split()]).repartition(3)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """The table's folder with labels and a benchmark, and documents written to files."""
    at = tmp_path_factory.mktemp("hostile")
    spark.createDataFrame([(1, 1, "x"), (3, 0, "x"), (3, 0, "x"), (2, None, "x"), (None, 1, "x"), (8, 1, "x")], "doc_id long, quality int, good string").write.parquet(f"{at}/labels.parquet")
    spark.createDataFrame([(1, ITEM, "x"), (2, None, "x"), (3, "", "x")], "item_id long, text string, doc_id string").write.parquet(f"{at}/benchmark.parquet")
    for name, rows in (("documents", ROWS), ("empty", [])):
        table(spark, rows).write.parquet(f"{at}/{name}.parquet")
    return str(at)


OPERATORS = {
    "op1": lambda s, d, docs: ctw.score_corpus(docs, F.col("doc_id") != 3),
    "op2": lambda s, d, docs: superminhash.near_duplicates(docs),
    "op4": lambda s, d, docs: wordbpe.encode_and_check(docs),
    "op6": lambda s, d, docs: linecrf.score_documents(docs, linecrf.train(docs, s.read.parquet(f"{d}/labels.parquet")), ["doc_id", "good", "score_"], "score"),
    "op7": lambda s, d, docs: hyperlang.identify(docs, hyperlang.prototypes(docs)),
    "op8": lambda s, d, docs: telephony.features(telephony.resampled(telephony.media_column(docs))),
    "op9": lambda s, d, docs: bitpack.read_ids(*bitpack.write_ids(docs)),
    "op11": lambda s, d, docs: alignment.align_documents(docs),
    "op13": lambda s, d, docs: ngramjoin.linked_components(docs),
    "op10": lambda s, d, docs: sharding.balanced_shards(docs, 4),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_a_row_for_each_row(spark, tables, name):
    run = lambda table: OPERATORS[name](spark, tables, spark.read.parquet(f"{tables}/{table}.parquet")).collect()
    found = run("documents")
    ids = lambda rows: sorted(-1 if r is None else r for r in rows)
    assert ids(r.doc_id for r in found) == ids(d for d, _ in ROWS)
    assert run("empty") == []


def test_rows_of_texts(spark, tables):
    """Operators that look at an id's texts, and at equal rows, as one."""
    docs, empty = (spark.read.parquet(f"{tables}/{t}.parquet") for t in ("documents", "empty"))
    bench = spark.read.parquet(f"{tables}/benchmark.parquet")
    hits = {(r.doc_id, r.n_hit) for r in decontaminate.contamination(docs, bench).collect() if r.n_hit}
    assert hits == {(2, 12), (None, 12)} and decontaminate.contamination(docs, bench).count() == len(set(ROWS))
    spans = suffixdedup.repeated_spans(docs).collect()
    assert {r.doc_id for r in spans} == {1, 2}  # the long text of 8 has no 50 words twice
    groups = {(r.doc_id, r.component_id) for r in superminhash.near_duplicates(docs).collect()}
    assert {(1, 1), (2, 1), (6, 6), (7, 6), (None, None)} <= groups
    assert decontaminate.contamination(empty, bench).count() == suffixdedup.repeated_spans(empty).count() == 0


def test_stages(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, tables)
        found = {(r.doc_id, r.text) for r in out.collect()}
        assert out.columns == docs.columns and found, name
        if name == "decontamination":
            assert found == {r for r in ROWS if ITEM not in (r[1] or "")}
        elif name == "near_dedup":
            assert {r for r in found if r[0] in (1, 2, 6, 7)} == {(1, PLAIN), (6, "one")}
    assert corpus_pipeline.bpe(spark, docs, tables).count() == len(ROWS)


def test_each_stage_over_no_rows(spark, tables):
    empty = spark.read.parquet(f"{tables}/empty.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, empty, tables)
        assert out.collect() == [] and (name == "bpe" or out.columns == empty.columns), name


def test_pipeline_over_the_hostile_table(spark, tables):
    found = corpus_pipeline.run(spark, tables)
    assert found.columns == ["doc_id", "lang", "source", "n_tokens", "ids", "decoded_sha256"]
    ids = [r.doc_id for r in found.collect()]
    assert set(ids) <= {d for d, _ in ROWS} and ids.count(4) == ids.count(5) <= 1  # empty texts go or stay alike


def test_pipeline_over_an_empty_table(spark, tables, tmp_path):
    for name in ("labels", "benchmark"):
        os.symlink(f"{tables}/{name}.parquet", f"{tmp_path}/{name}.parquet")
    os.symlink(f"{tables}/empty.parquet", f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
