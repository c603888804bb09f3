"""The prefix table against the tiktoken library, round trips, appends and edits."""

import base64
import random

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from devdata_spark.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
SOME = st.one_of(
    st.text(max_size=60),
    st.text(alphabet="theanodr \n\t'sre1-.é中\x1c\x85​", max_size=80),
)


@pytest.fixture(scope="module")
def encoder():
    with open(PATH, "rb") as lines:
        return bpe.Encoder.parse(lines.read(), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def ids(packed):
    return list(memoryview(packed).cast("I"))


@settings(max_examples=300, deadline=None)
@given(text=SOME)
def test_equals_the_library(encoder, library, text):
    packed = encoder.encode(text)
    assert ids(packed) == library.encode_ordinary(text)
    assert encoder.decode(packed) == text.encode("utf-8", "replace")


def test_long_pieces_equal_the_library(encoder, library):
    rng = random.Random(5)
    for text in ("a" * 3000, " " * 3000 + "x", "".join(rng.choices("abcdeth", k=4000))):
        assert ids(encoder.encode(text)) == library.encode_ordinary(text)


@settings(max_examples=100, deadline=None)
@given(first=st.binary(max_size=40), more=st.binary(max_size=40))
def test_an_appended_table_is_the_whole_table(encoder, first, more):
    table = encoder.extended(first, encoder.table(first), more)
    assert table == encoder.table(first + more)
    whole = b"".join(encoder.bytes_of[t] for t in encoder.tokens(first + more, table))
    assert whole == first + more


def test_an_edited_table_is_the_new_table(encoder):
    rng = random.Random(3)
    content = bytes(rng.choices(b"theanodrs", k=600))
    table = encoder.table(content)
    for _ in range(20):
        start = rng.randrange(0, 500)
        end = start + rng.randrange(0, 5)
        new = bytes(rng.choices(b"theanodrs", k=rng.randrange(0, 5)))
        whole, edited = encoder.replaced(content, table, start, end, new)
        assert whole == content[:start] + new + content[end:]
        assert edited == encoder.table(whole)


@settings(max_examples=150, deadline=None)
@given(text=SOME, new=SOME, data=st.data())
def test_an_edited_text_equals_a_new_one(encoder, text, new, data):
    start = data.draw(st.integers(0, len(text)))
    end = data.draw(st.integers(start, len(text)))
    edited = bpe.EditableText(encoder, text)
    edited.replace(start, end, new)
    assert edited.ids() == encoder.encode(text[:start] + new + text[end:])
    edited.append(new)
    assert edited.ids() == encoder.encode(text[:start] + new + text[end:] + new)


def test_columns(spark, encoder):
    encode, decode = bpe.codec(spark, PATH, public_tokenizers.PATTERN)
    rows = [(1, "Hello  world"), (1, "Hello  world"), (2, None), (None, ""), (3, "ab " * 20_000)]
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING").withColumn("ids", F.lit(9))
    out = df.select("doc_id", "text", encode("text").alias("tokens"))
    out = out.select("*", decode("tokens").alias("back"), bpe.n_tokens(F.col("tokens")).alias("n"))
    for row in out.collect():
        if row.text is None:
            assert row.tokens is None and row.back is None and row.n is None
        else:
            assert bytes(row.tokens) == encoder.encode(row.text)
            assert bytes(row.back).decode() == row.text and row.n == len(row.tokens) / 4
    assert out.filter("false").collect() == []


def test_an_idle_worker_forgets(monkeypatch):
    import time

    forgotten = []
    monkeypatch.setattr(bpe, "IDLE_SECONDS", 0.05)
    monkeypatch.setattr(bpe, "_forget", lambda: forgotten.append(1) or False)
    use = bpe._Use()
    with use, use:
        time.sleep(0.3)
        assert not forgotten  # not while there is work
    time.sleep(0.3)
    assert forgotten


def test_small_memos_keep_what_is_used_and_give_the_same(encoder, library):
    rng = random.Random(9)
    small = bpe.Encoder(encoder.ranks, public_tokenizers.PATTERN, entries=50)
    words = ["".join(rng.choices("theandrs", k=rng.randrange(3, 12))) for _ in range(2000)]
    for at in range(0, len(words), 20):
        text = " often asked " + " ".join(words[at : at + 20])
        assert ids(small.encode(text)) == library.encode_ordinary(text)
        assert " asked" in small.packed or " asked" in small.packed.old
    for memo in (small.packed, small.packed.old, small._fits, small._old_fits):
        assert len(memo) <= 50
    assert max(len(small._last), len(small._old_last)) <= 50 + bpe.MEMO_PIECE_BYTES


def test_round_trip_encodes_each_text_once(spark, encoder):
    both = bpe.round_trip(spark, PATH, public_tokenizers.PATTERN, entries=50)
    rows = [(1, "Hello  world"), (1, "Hello  world"), (2, None), (None, ""), (3, "ab " * 20_000)]
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    out = df.select("doc_id", "text", both("text").alias("made")).select("text", "made.*")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("both(") == 1 and "ArrowEvalPython" not in plan
    for row in out.collect():
        if row.text is None:
            assert row.ids is None and row.decoded is None
        else:
            assert bytes(row.ids) == encoder.encode(row.text)
            assert bytes(row.decoded).decode() == row.text


def test_the_pipeline_encodes_once_and_in_small_batches(spark):
    import corpus_pipeline

    docs = spark.createDataFrame([(1, "Hello  world"), (2, None)], "doc_id BIGINT, text STRING")
    out = corpus_pipeline.encode(spark, docs, "")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" in plan and "ArrowEvalPython" not in plan
    found = {r.doc_id: (bytes(r.tokens), r.n_tokens, r.round_trip) for r in out.collect()}
    assert found[2] == (b"", 0, True) and found[1][1:] == (len(found[1][0]) // 4, True)
