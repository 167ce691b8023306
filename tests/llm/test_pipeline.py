"""The corpus pipeline: every stage against another engine or plain Python, on its own input."""

import hashlib

import duckdb
import pytest
import sentencepiece
from test_against_brute_force import groups_by_hand

import corpus_pipeline
from shelfwise.llm.oracle import DECONTAMINATE, LINE_DEDUP, QUALITY_RULES
from shelfwise.llm.sentence_pieces import MODEL

PASSAGE = "a passage of ten words or more that a benchmark item has as it is"
COPY = " ".join(f"word{i}" for i in range(300))
PLANTED = [
    (900_001, COPY, "en", "src1", len(COPY)),
    (900_002, COPY + " changed", "en", "src2", len(COPY) + 8),
    (900_003, "Before it, " + PASSAGE + ", after it and on.", "en", "src3", 85),
    (900_004, "word " * 40, "en", "src4", 200),
    (900_005, None, None, None, None),
    (None, "ten or so words of a document without any id", "en", "src5", 44),
]


@pytest.fixture(scope="module")
def folder(spark, sf_dir, tmp_path_factory):
    """The tables with a few planted rows."""
    folder = tmp_path_factory.mktemp("tables")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs.unionByName(spark.createDataFrame(PLANTED, docs.schema)).write.parquet(f"{folder}/documents.parquet")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    items.unionByName(spark.createDataFrame([(7777, PASSAGE)], items.schema)).write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


@pytest.fixture(scope="module")
def steps(spark, folder):
    """What goes into each stage, and at last the result."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    found = [docs.toPandas()]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, folder).write.parquet(f"{folder}/step{k}")
        docs = spark.read.parquet(f"{folder}/step{k}")
        found.append(docs.toPandas())
    return found


def ids(table):
    return sorted(-1 if x != x else int(x) for x in table["doc_id"])


def answer(folder, step, sql):
    duck = duckdb.connect()
    source = f"{folder}/documents.parquet" if step == 0 else f"{folder}/step{step - 1}"
    duck.execute(f"create view documents as select coalesce(doc_id, -1) as doc_id, * exclude (doc_id) from '{source}/*.parquet'")
    duck.execute(f"create view benchmark as select * from '{folder}/benchmark.parquet/*.parquet'")
    return duck.execute(sql).fetchdf()


def test_quality_stage(steps, folder):
    wanted = answer(folder, 0, QUALITY_RULES)
    assert ids(steps[1]) == sorted(wanted[wanted["kept"]]["doc_id"])
    assert not {900_004, 900_005} & set(ids(steps[1]))


def test_line_stage(steps, folder):
    wanted = answer(folder, 1, LINE_DEDUP.replace("min(doc_id) as home", "min(nullif(doc_id, -1)) as home").replace("home = doc_id", "home = nullif(doc_id, -1)"))
    found = {(-1 if r.doc_id != r.doc_id else int(r.doc_id)): hashlib.sha256(r.text.encode()).hexdigest() for r in steps[2].itertuples()}
    assert found == dict(zip(wanted["doc_id"].tolist(), wanted["kept_sha256"], strict=True))
    assert all(r.n_chars == len(r.text) for r in steps[2].itertuples())


def test_near_duplicate_stage(steps):
    texts = {int(r.doc_id): r.text for r in steps[2].itertuples() if r.doc_id == r.doc_id}
    groups = groups_by_hand(texts, 5, 80)
    wanted = sorted(k for k, (n, component) in groups.items() if component == k)
    assert [x for x in ids(steps[3]) if x >= 0] == wanted
    assert 900_001 in wanted and 900_002 not in wanted


def test_benchmark_stage(steps, folder):
    wanted = answer(folder, 3, DECONTAMINATE)
    assert ids(steps[4]) == sorted(wanted[~wanted["contaminated"]]["doc_id"])
    assert 900_003 in ids(steps[3]) and 900_003 not in ids(steps[4])


def test_last_stage_and_run(steps, spark, folder):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for row in steps[5].itertuples():
        assert list(row.piece_ids) == library.encode(row.text)
    assert ids(steps[5]) == ids(steps[4])
    whole = corpus_pipeline.run(spark, folder).toPandas()
    assert ids(whole) == ids(steps[5])
    assert list(whole.columns) == ["doc_id", "text", "lang", "source", "n_chars", "piece_ids"]


def test_stages_keep_the_columns(steps):
    for table in steps[:5]:
        assert list(table.columns) == ["doc_id", "text", "lang", "source", "n_chars"]


def test_an_empty_corpus(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
    assert docs.count() == 0 and "piece_ids" in docs.columns
