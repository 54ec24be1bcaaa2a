import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from attain.llm import queries, tokens
from attain.llm.queries import tokenizer_path
from cases import awkward, frame

FILES = ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"]
TEXT = st.text(st.sampled_from("ab 'strelvmd\n\t 　 ​᠎\x1c\x851٣!.,<|>İßΣσ。你好の한é́▁\U0001f600") | st.characters(codec="utf-8"), max_size=80)
ODD = ["", " ", "  a", "<|endoftext|> inside <|endoftext|>", "x<|endoftext|>y", "a" * 20_000, " " * 20_000, "\n" * 3000 + "x", "你好" * 5000, "ab12" * 4000,
       "it's we'll I'D 'thing " * 500, "Σ ΑΣ " * 800, "。" * 3000 + "word", "<s> </s> <unk> <0x41> " * 300, "\x00a \x00", "é " * 900, "the " * 9000]


def plain(path, text):
    """Tokens of a text as its library counts them, without any splitting."""
    if path.endswith(".json"):
        from tokenizers import Tokenizer

        return len(Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids)
    import sentencepiece

    return len(sentencepiece.SentencePieceProcessor(model_file=path).encode(text))


@pytest.mark.parametrize("name", FILES)
def test_odd_texts_count_as_whole_ones(name):
    path = tokenizer_path(name)
    lib = tokens.library(path)
    for chars in (1, 7, 1000):
        for text in ODD:
            assert "".join(lib.parts(text, chars)) == text
            assert tokens.lengths(pa.array([text]), lib, 500, chars).tolist() == [plain(path, text) if text else 0], (text[:20], chars)


@settings(max_examples=300, deadline=None)
@given(st.lists(TEXT, max_size=5), st.integers(1, 5), st.integers(1, 40))
def test_parts_add_up(texts, chars, batch_bytes):
    for name in FILES:
        path = tokenizer_path(name)
        lib = tokens.library(path)
        whole = [lib.count([t], [True])[0] if t else 0 for t in texts]
        assert tokens.lengths(pa.array(texts, pa.string()), lib, batch_bytes, chars).tolist() == whole


@pytest.mark.parametrize("name", FILES)
def test_long_texts_are_cut(name):
    lib = tokens.library(tokenizer_path(name))
    parts = list(lib.parts("some words of prose, in a line. " * 5000, 1000))
    assert len(parts) > 100 and max(map(len, parts)) < 1100
    chinese = list(lib.parts("你好，世界。" * 5000, 1000))
    assert len(chinese) > 10 or name == "word_bpe_49k.json"  # no white space, and this one lower-cases first


def test_millions_of_one_character():
    lib = tokens.library(tokenizer_path())
    for character, each in ((" ", 1), ("\t", 1), ("a", 4)):
        text = character * 2_000_000
        assert tokens.lengths(pa.array([text]), lib, 1 << 18, 1 << 16)[0] == plain(tokenizer_path(), text) > 400_000


def test_awkward_rows(spark):
    docs = frame(spark, awkward()).withColumnRenamed("bits", "n_tokens").withColumnRenamed("slot", "n_bytes")
    found = sorted(tokens.count_tokens(docs, tokenizer_path(), limit=100).collect(), key=str)
    wanted = sorted(((i, len((t or "").encode()), plain(tokenizer_path(), t or ""), plain(tokenizer_path(), t or "") > 100) for i, t in awkward()), key=str)
    assert sorted(map(str, (tuple(r) for r in found))) == sorted(map(str, wanted))
    assert tokens.count_tokens(docs.where("false"), tokenizer_path()).collect() == []
    by_model = {r["doc_id"]: r["n_tokens"] for r in tokens.count_tokens(docs.where("doc_id = 6"), tokenizer_path(FILES[2])).collect()}
    assert by_model == {6: plain(tokenizer_path(FILES[2]), dict(awkward())[6])}


def test_the_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    found = queries.op11_token_counts(spark, folder)
    assert found.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    rows = {r["doc_id"]: r for r in found.collect()}
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    assert len(rows) == len({d["doc_id"] for d in docs})
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(tokenizer_path())
    for d in docs:
        n = len(lib.encode(d["text"] or "", add_special_tokens=False).ids)
        assert (rows[d["doc_id"]]["n_bytes"], rows[d["doc_id"]]["n_tokens"], rows[d["doc_id"]]["over_limit"]) == (len((d["text"] or "").encode()), n, n > 1024)


def test_other_files_are_refused():
    with pytest.raises(ValueError):
        tokens.library("/tmp/vocabulary.txt")
