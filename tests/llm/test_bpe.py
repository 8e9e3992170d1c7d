import base64
import glob
import random

import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm.bpe import PATTERN, TOKENIZERS, RankQueue, encode, encoder

PATH = f"{TOKENIZERS}/byte_bpe_50k.tiktoken"


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_queue_pops_lowest_rank_then_leftmost():
    rng, q = random.Random(1), RankQueue(50_256)
    items = [(rng.choice((rng.randrange(50_256), 7, 4096, 63, 64)), rng.randrange(10_000)) for _ in range(3000)]
    for r, p in items:
        q.push(r, p)
    assert [q.pop() for _ in items] == sorted(items) and q.pop() is None and not any(q.low)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text(reference, text):
    assert encoder(PATH).encode(text) == reference.encode_ordinary(text)


def test_very_long_pre_tokens(reference):
    rng = random.Random(2)
    for text in ("a" * 20_000, "ab" * 9_999 + "c", "".join(rng.choice("abcdefgh") for _ in range(20_000)), "ม" * 5_000, "=" * 7_001, " " * 5_000 + "x"):
        assert encoder(PATH).encode(text) == reference.encode_ordinary(text)


def test_rows(spark, reference):
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "<|endoftext|> don't"), (4, "<|endoftext|> don't"), (None, "x"), (5, "　")]
    df = spark.createDataFrame([(i, t, "c") for i, t in rows], "doc_id bigint, text string, ids string")
    got = sorted(((r.doc_id, r.ids) for r in encode(df).collect()), key=str)
    assert got == sorted(((i, reference.encode_ordinary(t or "")) for i, t in rows), key=str)
    assert encode(df.limit(0)).count() == 0


def test_against_libraries_on_the_corpus(spark, reference):
    from tokenizers import Tokenizer

    other = Tokenizer.from_file(f"{TOKENIZERS}/byte_bpe_50k.json")
    other.encode_special_tokens = True
    if not glob.glob("/root/testdata/sf0.01/documents.parquet"):
        pytest.skip("no data")
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = {r.doc_id: r.text or "" for r in df.collect()}
    for r in encode(df).collect():
        assert r.ids == reference.encode_ordinary(want[r.doc_id]) == other.encode(want[r.doc_id], add_special_tokens=False).ids
