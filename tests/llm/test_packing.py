import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from attain.llm import packing
from attain.llm.queries import tokenizer_path
from cases import awkward, frame, prose


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 300), st.integers(0, 300)), max_size=40), st.integers(1, 6), st.integers(1, 100))
def test_every_token_once_within_all_limits(sizes, segments, loss):
    tokens = np.array([a for a, _ in sizes], np.int64)
    bears = np.array([min(a, b) for a, b in sizes], np.int64)
    limits = packing.Limits(100, segments, loss)
    pieces = packing.pack_group(tokens, bears, limits)
    at = [0] * len(tokens)
    used = {}
    for i, start, length, lost, sequence, offset in pieces:
        assert start == at[i] and length > 0
        at[i] += length
        first = tokens[i] - bears[i]
        assert lost == max(0, start + length - max(first, start))
        room = used.setdefault(sequence, [0, 0, 0])
        assert offset == room[0]
        room[0], room[1], room[2] = room[0] + length, room[1] + 1, room[2] + lost
    assert at == tokens.tolist()
    assert all(a <= 100 and b <= segments and c <= loss for a, b, c in used.values())


def test_little_padding():
    rng = np.random.default_rng(0)
    tokens = rng.integers(1, 5000, 500)
    pieces = packing.pack_group(tokens, tokens, packing.Limits())
    n = max(p[4] for p in pieces) + 1
    assert tokens.sum() / (n * 2048) > 0.995


def reference_ids(text):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path())
    t.encode_special_tokens = True
    return t.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("text", ["", "Plain words, 123!", "é 你好 \U0001f600", "<|endoftext|> inside", "a" * 3000, " \n\t " * 500, "it's we'll I'D"])
def test_ids_equal_those_of_the_tokenizers_library(text):
    assert packing.encoder(tokenizer_path())(text) == reference_ids(text)


def test_ids_of_real_documents(spark):
    for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect():
        assert packing.encoder(tokenizer_path())(r["text"] or "") == reference_ids(r["text"])


def test_round_trip_of_awkward_rows(spark):
    docs = frame(spark, awkward()).coalesce(1)
    rows = packing.pack(docs, tokenizer_path(), group_tokens=4000).collect()
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    for own in by_sequence.values():
        own.sort(key=lambda r: r["offset"])
        ends = np.cumsum([r["length"] for r in own])
        assert [r["offset"] for r in own] == [0, *ends[:-1]] and ends[-1] <= 2048
    pieces = {}
    for r in rows:
        assert len(r["ids"]) == 4 * r["length"]
        pieces.setdefault((r["doc_id"], r["doc_tokens"]), []).append(r)
    for i, text in awkward():
        ids = np.array(reference_ids(text) + [1], "<u4")
        own = pieces[i, len(ids)]
        got = sorted({(r["start"], bytes(r["ids"])) for r in own})
        copies = sum(1 for j, t in awkward() if j == i and len(reference_ids(t)) + 1 == len(ids))
        assert sum(r["length"] for r in own) == copies * len(ids)
        if copies == 1:
            assert b"".join(b for _, b in got) == ids.tobytes()


def test_special_tokens_as_the_library_has_them_by_default(spark):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path())
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>\n", "<|endoftext|", "plain"]
    for r in packing.pack(frame(spark, list(enumerate(texts))), tokenizer_path(), end_id=None).collect():
        assert np.frombuffer(r["ids"], "<u4").tolist() == t.encode(texts[r["doc_id"]], add_special_tokens=False).ids


def test_instruction_data(spark):
    docs = spark.createDataFrame([(1, "a question here", "the answer"), (2, None, "only answer"), (3, "only prompt", None)], "doc_id long, prompt string, text string")
    rows = {r["doc_id"]: r for r in packing.pack(docs, tokenizer_path(), prompt_col="prompt", end_id=None).collect()}
    assert rows[1]["loss_tokens"] == len(reference_ids("the answer")) and rows[3]["loss_tokens"] == 0
    assert rows[2]["loss_tokens"] == rows[2]["doc_tokens"]


def test_empty_table(spark):
    assert packing.pack(frame(spark, []).limit(0), tokenizer_path()).count() == 0


def test_query_covers_all_documents(spark):
    from attain.llm.queries import op5_vector_packing

    rows = op5_vector_packing(spark, "/root/testdata/sf0.001").toPandas()
    assert (rows.groupby("doc_id").length.sum() == rows.groupby("doc_id").doc_tokens.first()).all()
    fill = rows.groupby("sequence_id").length.sum()
    assert fill.max() <= 2048 and fill.sum() / (2048 * len(fill)) > 0.97
    assert prose(1, 2)


@pytest.mark.parametrize("character", [" ", "\t", "\n"])
def test_millions_of_blanks(character):
    for n in (1_000_000, 2_000_000, 5_000_000):
        text = "x" + character * n + "y <|endoftext|>"
        from tokenizers import Tokenizer

        assert packing.encoder(tokenizer_path())(text) == reference_ids(text)
        assert packing.encoder(tokenizer_path(), special=True)(text) == Tokenizer.from_file(tokenizer_path()).encode(text, add_special_tokens=False).ids


def test_many_short_examples_in_little_time():
    import time

    tokens = np.ones(1_000_000, np.int64)
    started = time.time()
    pieces = packing.pack_group(tokens, tokens, packing.Limits())
    assert time.time() - started < 60 and len(pieces) == len(tokens)
    assert pieces[:, 4].max() + 1 == -(-len(tokens) // 2048)  # no padding but in the last
    mixed = np.random.default_rng(3).integers(1, 15, 20_000)
    pieces = packing.pack_group(mixed, mixed, packing.Limits())
    assert pieces[:, 4].max() + 1 == -(-mixed.sum() // 2048)
    assert (np.bincount(pieces[:, 0], pieces[:, 2]) == mixed).all()


def test_many_empty_texts(spark):
    rows = packing.pack(frame(spark, [(i, None if i % 2 else "") for i in range(6000)]).coalesce(1), tokenizer_path()).toPandas()
    assert len(rows) == 6000 and rows.sequence_id.nunique() == 3
