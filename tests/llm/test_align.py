import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from attain.llm import align, queries
from attain.llm.queries import tokenizer_path
from cases import awkward, frame, prose

A, B = tokenizer_path(), tokenizer_path("piece_bpe_32k.model")
TEXT = st.text(st.sampled_from("ab 'stre\n\t  　١1!.,<|>ß。你好の한é́▁\U0001f600") | st.characters(codec="utf-8"), min_size=1, max_size=60)


def by_hand(text):
    """(a ids, b ids, groups) of a text, token by token; None where it has no tokens."""
    import sentencepiece
    from tokenizers import Tokenizer

    if not hasattr(by_hand, "a"):
        by_hand.a, by_hand.b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
        by_hand.a.encode_special_tokens = True
        from tokenizers.decoders import ByteLevel  # noqa: F401
        from tokenizers.pre_tokenizers import ByteLevel as Alphabet

        assert len(Alphabet.alphabet()) == 256
    if not text:
        return None
    two = align.pair(A, B)
    a = by_hand.a.encode(" " + text, add_special_tokens=False).ids
    b = by_hand.b.encode(text)
    piece = [by_hand.b.id_to_piece(i) for i in b]
    bytes_b = [bytes([int(p[3:5], 16)]) if by_hand.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, piece)]
    bytes_a = [two.va.bytes[i] for i in a]
    if b"".join(bytes_a) != (" " + text).encode() or b"".join(bytes_b) != (" " + text).encode():
        return None
    links, i, j, at_a, at_b = [], 0, 0, 0, 0
    groups, own_a, own_b = [], [], []
    while i < len(a) and j < len(b):
        links.append((a[i], b[j]))
        end_a, end_b = at_a + len(bytes_a[i]), at_b + len(bytes_b[j])
        if end_a <= end_b:
            own_a.append(a[i])
            i, at_a = i + 1, end_a
        if end_b <= end_a:
            own_b.append(b[j])
            j, at_b = j + 1, end_b
        if end_a == end_b:
            groups.append((own_a, own_b))
            own_a, own_b = [], []
    assert i == len(a) and j == len(b) and not own_a and not own_b
    return a, b, groups, links


def written(groups):
    return ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)


def expected(rows):
    done = [(i, by_hand(t)) for i, t in rows]
    counts = Counter(x for _, d in done if d for x in d[3])
    best = defaultdict(int)
    for (a, b), n in counts.items():
        best[b] = max(best[b], n)
    return [(i, 0, 0, 0, 0, 0, 0, "") if d is None else
            (i, len(d[0]), len(d[1]), len(d[2]), len(d[3]), sum(counts[x] == best[x[1]] for x in d[3]), sum(counts[x] for x in d[3]),
             hashlib.sha256(written(d[2]).encode()).hexdigest()) for i, d in done]


def fragments(text, chars):
    two = align.pair(A, B)
    parts = list(align.chunks_of(text, two, chars))
    bounds = np.array([p[1:] for p in parts], np.int64)
    runs = align.tokenise([p[0] for p in parts], bounds, [k == 0 for k in range(len(parts))], two)
    return None if any(r is None for r in runs) else align.align(runs, two)


@settings(max_examples=200, deadline=None)
@given(TEXT, st.integers(1, 8), st.randoms())
def test_any_composition_of_any_chunks_gives_the_whole(text, chars, rng):
    two, whole = align.pair(A, B), by_hand(text)
    done = fragments(text, chars)
    if whole is None:
        assert done is None
        return
    # (fragment, texts in order, links)
    parts = [(f, [g.text], g.n_links, Counter(dict(zip(zip(g.pair_a.tolist(), g.pair_b.tolist()), g.pair_n.tolist())))) for f, g in done]
    while len(parts) > 1:  # neighbours in any order
        k = rng.randrange(len(parts) - 1)
        (x, tx, nx, cx), (y, ty, ny, cy) = parts[k:k + 2]
        z, g = align.compose(x, y, two)
        seam = Counter(dict(zip(zip(g.pair_a.tolist(), g.pair_b.tolist()), g.pair_n.tolist())))
        parts[k:k + 2] = [(z, [*tx, g.text, *ty], nx + ny + g.n_links, cx + cy + seam)]
    f, texts, links, counts = parts[0]
    assert f.closed and not len(f.head.a) and not len(f.head.b) and not len(f.tail.a) and not len(f.tail.b)
    assert b"".join(texts)[:-1].decode() == written(whole[2])
    assert links == len(whole[3]) and counts == Counter(whole[3])


@settings(max_examples=60, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=6))
def test_texts_found_together(texts):
    two = align.pair(A, B)
    bounds = np.array([[0, len(t), 0, len(t)] for t in texts], np.int64)
    runs = [r for r in align.tokenise(texts, bounds, [True] * len(texts), two)]
    found = iter(align.align([r for r in runs if r is not None], two))
    for text, run in zip(texts, runs):
        whole = by_hand(text)
        assert (whole is None) == (run is None)
        if run is not None:
            assert next(found)[1].text[:-1].decode() == written(whole[2])


def test_chunks_that_do_not_meet():
    """Cuts of both sides lie apart, so that prefixes and suffixes are open."""
    done = fragments(prose(5, 400) + "你好，世界，" * 200, 50)
    assert any(len(f.head.a) for f, _ in done) or any(f.tail is not None and len(f.tail.a) for f, _ in done)


ROWS = awkward() + [(20, "▁ a sign that stands for a space"), (21, "<|endoftext|> and <s> </s> <0x41>"), (22, "你好，世界。" * 700),
                    (23, prose(3, 900) + " ▁"), (24, "\x00 zero"), (25, prose(3, 900))]


@pytest.mark.parametrize("chars, held", [(1 << 16, 1 << 19), (150, 40), (900, 0)])
def test_awkward_rows_against_brute_force(spark, chars, held):
    docs = frame(spark, ROWS).withColumnRenamed("slot", "n_links").withColumnRenamed("bits", "key")
    found = align.align_documents(docs, A, B, chunk_chars=chars, held_pairs=held)
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(str(tuple(r)) for r in found.collect()) == sorted(map(str, expected(ROWS)))


def test_empty_table(spark):
    docs = frame(spark, [(1, "a")])
    assert align.align_documents(docs.where("false"), A, B).collect() == []
    only = align.align_documents(frame(spark, [(1, None), (2, "")]), A, B).collect()
    assert sorted(tuple(r) for r in only) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_the_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    docs = [(d["doc_id"], d["text"]) for d in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    found = queries.op12_alignment(spark, folder).collect()
    assert sorted(tuple(r) for r in found) == sorted(expected(docs))
