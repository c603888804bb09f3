"""The pipeline's stages take effect, keep the columns and end in exact tokens."""

import base64
import os

import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from devdata_spark.llm import contamination

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not there")


@pytest.fixture(scope="module")
def results(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    found = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF_DIR).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        found.append(docs)
    return found


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stages_return_the_columns_of_documents(results):
    for df in results[1:-1]:
        assert df.columns == results[0].columns and dict(df.dtypes) == dict(results[0].dtypes)


def test_labelled_toxic_documents_go(spark, results):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()
    before, after = texts(results[0]), texts(results[1])
    assert after.items() <= before.items()
    clean = [r.doc_id for r in labels if not r.toxic and r.doc_id in before]
    assert sum(i in after for i in clean) >= 0.97 * len(clean)


def test_lines_go_and_documents_stay(results):
    before, after = texts(results[1]), texts(results[2])
    assert before.keys() == after.keys()
    left = [line for t in after.values() for line in (t or "").split("\n") if line.strip()]
    assert len(left) == len(set(left))
    assert all(r.n_chars == len(r.text) for r in results[2].collect())
    for i, t in after.items():
        assert set(t.split("\n")) <= {*before[i].split("\n"), ""}


def test_lines_go_from_documents_with_other_columns(spark):
    schema = "row INT, doc_id BIGINT, text STRING, n_chars BIGINT, n_lines INT, n_removed INT, document INT"
    docs = spark.createDataFrame([(7, i, f"one line of all\nown {i}", 9, 5, 6, 8) for i in (1, 2)], schema)
    found = corpus_pipeline.drop_lines(spark, docs, SF_DIR)
    assert found.columns == docs.columns
    assert sorted(tuple(r) for r in found.collect()) == [
        (7, 1, "one line of all\nown 1", 21, 5, 6, 8), (7, 2, "own 2", 5, 5, 6, 8)
    ]


def test_one_of_each_group_of_copies_stays(results):
    before, after = texts(results[2]), texts(results[3])
    assert after.items() <= before.items()
    full = [t for t in after.values() if t.split()]
    assert len(full) == len(set(full))


def test_copies_with_words_appended_go(spark):
    base = [f"w{i}" for i in range(200)]
    rows = [(1, " ".join(base)), (2, " ".join(base + [f"x{i}" for i in range(30)])),
            (3, " ".join(base + [f"y{i}" for i in range(70)])), (4, "else")]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    kept = corpus_pipeline.drop_copies(spark, docs, SF_DIR)
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 4]


def test_no_benchmark_item_is_left(spark, results):
    items = [r.text for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    after = texts(results[4])
    assert after.items() <= texts(results[3]).items()
    assert not any(item in text for item in items if len(item) >= 100 for text in after.values())


def test_tokens_are_those_of_the_library(results):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    source = texts(results[4])
    rows = results[5].collect()
    assert {r.doc_id for r in rows} == source.keys()
    for r in rows:
        expected = library.encode_ordinary(source[r.doc_id] or "")
        assert list(memoryview(bytes(r.tokens)).cast("I")) == expected
        assert r.n_tokens == len(expected) and r.round_trip


def test_run_gives_the_last_stage(spark, results):
    found = corpus_pipeline.run(spark, SF_DIR)
    assert sorted(r.doc_id for r in found.collect()) == sorted(r.doc_id for r in results[5].collect())


def test_decontamination_takes_small_batches_and_finds_the_same(spark):
    benchmark = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    items = [r.text for r in benchmark.limit(3).collect()]
    rows = [(i, f"before {t} and behind") for i, t in enumerate(items)] + [(8, None), (9, "else")]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    left = corpus_pipeline.drop_contaminated(spark, docs, SF_DIR)
    plan = left._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" in plan and "ArrowEvalPython" not in plan
    one, many = (contamination.finder(benchmark, batched=b)("text") for b in (False, True))
    found = docs.select("doc_id", one.alias("one"), many.alias("many")).collect()
    for r in found:
        assert {m[:2] for m in r.one} == {m[:2] for m in r.many}
    assert sorted(r.doc_id for r in left.collect()) == [r.doc_id for r in found if not r.many]
