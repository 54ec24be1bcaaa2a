import math
from collections import Counter

import numpy as np
import pytest

from attain.llm import lm
from cases import awkward, frame, prose


def tokens(text):
    return (text or "").encode().lower().split() + [b"\n"]


def expected(train, texts):
    counts = Counter(w for t in train for w in tokens(t))
    total, known = sum(counts.values()), len(counts)
    out = []
    for text in texts:
        words = tokens(text)
        out.append((len(words), sum(counts[w] > 0 for w in words), total,
                    sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (known + 1))) for w in words)))
    return out


def test_base_score_by_brute_force(spark, monkeypatch):
    monkeypatch.setattr(lm, "HELD", 7)  # most counts come by the join
    rows = [(i, prose(i, 5 + i)) for i in range(40)]
    docs = frame(spark, rows + awkward())
    out = lm.score(docs, lm.fit(frame(spark, rows)))
    got = sorted((r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in out.collect())
    want = sorted((a, b, c, round(d, 6)) for a, b, c, d in expected([t for _, t in rows], [t for _, t in rows + awkward()]))
    assert len(got) == len(want)
    assert all(g[:3] == w[:3] and abs(g[3] - w[3]) < 1e-4 for g, w in zip(got, want))


def test_the_model_is_a_distribution(spark):
    """Over all known words and one unknown word of each leaf, the probabilities sum to one."""
    rows = [(i, prose(i, 30, "aa bb cc dd ee")) for i in range(30)]
    counts, vocab, weights = lm.fit(frame(spark, rows))
    w = lm.Weights(vocab, weights.class_rows, weights.leaf_rows)
    before = np.array([vocab.own[b"aa"], vocab.own[b"bb"], 0])
    codes = lm.features(before, np.array([0, 3]))[:, 2:3]
    p = lm.softmax(w.class_rows, lm.class_index(codes), w.class_bias)[0]
    total = 0.0
    for c in range(lm.CLASSES):
        q = lm.softmax(w.leaf_rows, lm.leaf_index(codes, np.array([c])), w.leaf_bias[[c]])[0]
        for k in range(lm.LEAVES):
            leaf = k * lm.CLASSES + c
            inside = (vocab.tokens[leaf] + 0.5 * vocab.words[leaf] + 0.5) / (vocab.tokens[leaf] + 0.5 * (vocab.words[leaf] + 1))
            total += p[c] * q[k] * inside
    assert abs(total - 1) < 1e-4


def test_context_helps_on_unseen_texts(spark):
    rng = np.random.default_rng(1)
    follow = {w: rng.permutation(40)[:3] for w in range(40)}

    def walk(n):
        at, out = 0, []
        for _ in range(n):
            at = int(follow[at][rng.integers(3)])
            out.append(f"w{at}")
        return " ".join(out)

    train = frame(spark, [(i, walk(300)) for i in range(60)])
    test = frame(spark, [(i, walk(300)) for i in range(5)])
    got = lm.score(test, lm.fit(train, rounds=2)).collect()
    assert all(r["score"] > 0.8 * r["base_score"] for r in got)


@pytest.mark.parametrize("back", [1, 2, 3])
def test_words_up_to_three_before_help_in_one_round(spark, back):
    """Each word depends on one word before it alone; the query fits with one round."""
    rng = np.random.default_rng(2)
    follow = {w: rng.permutation(40)[:3] for w in range(40)}

    def walk(n):
        out = rng.integers(40, size=back).tolist()
        while len(out) < n:
            out.append(int(follow[out[-back]][rng.integers(3)]))
        return " ".join(f"w{x}" for x in out)

    train = frame(spark, [(i, walk(300)) for i in range(120)]).coalesce(2)
    test = frame(spark, [(i, walk(300)) for i in range(5)])
    got = lm.score(test, lm.fit(train)).collect()
    assert all(r["score"] > 0.8 * r["base_score"] for r in got), [r["score"] / r["base_score"] for r in got]


def test_empty_tables(spark):
    none = frame(spark, []).limit(0)
    some = frame(spark, [(1, "a b"), (2, None)])
    assert lm.score(none, lm.fit(some)).count() == 0
    rows = lm.score(some, lm.fit(none)).collect()
    assert sorted((r["n_tokens"], r["n_known"], r["train_tokens"]) for r in rows) == [(1, 0, 0), (3, 0, 0)]
    assert all(abs(r["base_score"]) < 1e-9 for r in rows)


def test_rows_repeat_and_only_texts_count(spark):
    docs = frame(spark, [(1, "a b c"), (1, "a b c"), (2, "A B C")])
    rows = lm.score(docs, lm.fit(docs)).collect()
    assert len(rows) == 3 and len({(r["score"], r["base_score"]) for r in rows}) == 1


def test_rare_words_meet_their_counts_without_a_shuffle_by_document_and_word(spark, monkeypatch):
    monkeypatch.setattr(lm, "HELD", 0)  # all counts come by the join, that of the end too
    rows = [(1, "a b a B"), (2, None), (3, " "), (4, "b new new\x0bnew  " * 3)]
    out = lm.score(frame(spark, rows), lm.fit(frame(spark, rows[:3])))
    plan = out._jdf.queryExecution().toString()
    assert "hashpartitioning(row#" in plan
    assert not [line for line in plan.splitlines() if "hashpartitioning(row#" in line and "word#" in line]
    got = sorted((r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in out.collect())
    want = sorted(expected([t for _, t in rows[:3]], [t for _, t in rows]))
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert all(abs(g[3] - w[3]) < 1e-9 for g, w in zip(got, want))
