import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from attain.llm import decontam, linedup, minhash, vectors
from attain.llm.common import Stages, components, shingles, word_codes
from cases import awkward, frame, prose


def closed(ids, pairs):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def edited(text, seed, n):
    rng, words = random.Random(seed), text.split()
    for _ in range(n):
        words[rng.randrange(len(words))] = f"edit{rng.randrange(10**6)}"
    return " ".join(words)


# ---------------------------------------------------------------- shared parts

def test_components(spark):
    rng = random.Random(4)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(500, 560)] + [(7, 7)]
    edges = spark.createDataFrame(pairs + [(None, 3)], "a long, b long")
    got = {r["id"]: r["component"] for r in components(edges, Stages(spark, "test")).collect()}
    want = closed({i for p in pairs for i in p}, pairs)
    assert got == {i: c for i, c in want.items() if any(i in p and p[0] != p[1] for p in pairs)}
    assert components(edges.limit(0), Stages(spark, "test")).count() == 0


def test_words_and_shingles_by_brute_force():
    texts = ["", " ", "One two", "a b c d e", "A b\tc\nd e f\x0bg", "é É x y z w", "one" * 50, " a b  c d e f "]
    data = "".join(texts).encode()
    offsets = np.cumsum([0, *(len(t.encode()) for t in texts)])
    codes, first = word_codes(offsets, np.frombuffer(data, np.uint8))
    words = [t.encode().lower().split() for t in texts]
    assert np.diff(first).tolist() == [len(w) for w in words]
    by_word = {}
    for i, own in enumerate(words):
        for w, c in zip(own, codes[first[i]:first[i + 1]].tolist()):
            assert by_word.setdefault(w, c) == c
    assert len(set(by_word.values())) == len(by_word)
    runs, at = shingles(codes, first)
    by_run = {}
    for i, own in enumerate(words):
        want = [tuple(own[k:k + 5]) for k in range(len(own) - 4)] if len(own) >= 5 else [tuple(own)] * bool(own)
        assert at[i + 1] - at[i] == len(want)
        for w, c in zip(want, runs[at[i]:at[i + 1]].tolist()):
            assert by_run.setdefault(w, c) == c
    assert len(set(by_run.values())) == len(by_run)


# ---------------------------------------------------------------- MinHash

def shingle_set(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[k:k + 5]) for k in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()


def near(rows):
    sets = [shingle_set(t) for _, t in rows]
    pairs = []
    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= 75 * len(sets[a] | sets[b]):
                pairs.append((b, a))
    return sets, closed(range(len(rows)), pairs)


def compare_near(spark, rows):
    got = minhash.near_duplicates(frame(spark, rows)).collect()
    sets, label = near(rows)
    least = defaultdict(list)
    for i, (doc, _) in enumerate(rows):
        least[label[i]].append(doc)
    want = []
    for i, (doc, _) in enumerate(rows):
        ids = [d for d in least[label[i]] if d is not None]
        component = (min(ids) if ids else None) if sets[i] else doc
        want.append((doc, len(sets[i]), component, doc == component))
    key = lambda r: tuple((v is not None, v or 0) for v in r)
    assert sorted((tuple(r) for r in got), key=key) == sorted(want, key=key)


def test_near_duplicates_of_awkward_rows(spark):
    compare_near(spark, awkward())


@pytest.mark.parametrize("few", [2, 5, 1000])
def test_near_duplicates_by_brute_force(spark, monkeypatch, few):
    monkeypatch.setattr(minhash, "CHUNK", 8)  # groups are larger than what is compared at once
    monkeypatch.setattr(minhash, "FEW", few)
    rows = []
    for family in range(6):
        base = prose(family, 60)
        rows += [(100 * family + k, edited(base, 50 * family + k, k % 4)) for k in range(30)]
    rows += [(2000 + i, prose(900 + i, 40)) for i in range(60)]
    random.Random(1).shuffle(rows)
    compare_near(spark, rows)


@pytest.mark.parametrize("ids", [True, False])
def test_near_duplicates_of_repeated_rows(spark, ids):
    rows = []
    for family in range(20):
        base = prose(family, 60)
        rows += [(10 * family + k if ids else None, edited(base, 50 * family + k, k)) for k in range(2)]
    compare_near(spark, rows + rows)


def test_chains_of_links(spark):
    words = prose(3, 200).split()
    compare_near(spark, [(i, " ".join(words[3 * i:3 * i + 80])) for i in range(30)])


def test_no_documents(spark):
    assert minhash.near_duplicates(frame(spark, []).limit(0)).count() == 0
    compare_near(spark, [(1, "only one text of a few words")])


def test_estimate_is_close():
    rng = np.random.default_rng(2)
    pool = rng.integers(0, 2**63, 4000, dtype=np.uint64)
    gaps = []
    for k in range(40):
        low = k * 20
        a, b = pool[low:low + 1000], pool[low + 100:low + 1100]
        signs = [np.frombuffer(minhash.packed(minhash.minima(x)), np.uint64) for x in (a, b)]
        gaps.append(float(minhash.estimate(signs[0][None], signs[1][None])[0]) - 900 / 1100)
    assert abs(np.mean(gaps)) < 0.02 and np.max(np.abs(gaps)) < minhash.MARGIN


# ---------------------------------------------------------------- lines

def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
    return row[-1]


def expected_lines(rows, max_edits, min_chars):
    places, docs = defaultdict(list), {}
    for doc, text in rows:
        for n, line in enumerate((text or "").split("\n") if text is not None else []):
            norm = line.strip(" \t\r").lower()
            if len(norm) >= min_chars:
                places[norm].append(((doc is None, doc or 0, n), (doc, text, n)))
    keys = list(places)
    pairs = [(a, b) for a in range(len(keys)) for b in range(a) if abs(len(keys[a]) - len(keys[b])) <= max_edits and edits(keys[a], keys[b]) <= max_edits]
    label = closed(range(len(keys)), [(b, a) for a, b in pairs])
    classes = defaultdict(list)
    for i, k in enumerate(keys):
        classes[label[i]] += places[k]
    lost = {own for found in classes.values() for order, own in found if order != min(found)[0]}
    return sorted(((doc, None if text is None else "\n".join(x for n, x in enumerate(text.split("\n")) if (doc, text, n) not in lost))
                   for doc, text in rows), key=str)


@pytest.mark.parametrize("max_edits", [0, 1, 2, 3])
def test_line_dedup_by_brute_force(spark, max_edits):
    rng = random.Random(max_edits)

    def mutate(line, n):
        for _ in range(n):
            at = rng.randrange(len(line))
            line = rng.choice([line[:at] + line[at + 1:], line[:at] + rng.choice("aeé你x") + line[at:], line[:at] + rng.choice("aex") + line[at + 1:]])
        return line

    bases = [prose(i, 3 + i % 4) for i in range(15)]
    lines = [mutate(b, n) for b in bases for n in range(6)] + ["short", "short", "The end."]
    rows = [(i, "\n".join(rng.choice(lines) for _ in range(rng.randint(0, 6)))) for i in range(50)]
    docs = frame(spark, rows + [(None, lines[0]), (None, None), (70, None), (71, "")])
    out = linedup.dedup_lines(docs, max_edits=max_edits, min_chars=12)
    assert out.columns == docs.columns + ["n_lines", "n_dropped"]
    got = sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=str)
    assert got == expected_lines([(r["doc_id"], r["text"]) for r in docs.collect()], max_edits, 12)


def test_near_and_short_lines_of_the_query_and_the_pipeline(spark, tmp_path):
    """Three edits in a line of any length count as near; short lines go where they repeat exactly, tiny and blank ones stay."""
    import corpus_pipeline
    from attain.llm.queries import op10_line_dedup

    line, other = prose(5, 50), "Some twenty characters"
    near = line[:40] + "#" + line[41:150] + "##" + line[150:]
    rows = [(1, f"{line}\n{other}\nErheed. Titionly.\n\nab"), (2, f"{near}\nnew line number two here\n  erheed. titionly.\n\nab"),
            (3, "Erheed. Titionly!\nSome twenti charakter\nab\nab"), (4, line[:-5] + "four!!")]
    want = {1: rows[0][1], 2: "new line number two here\n\nab", 3: "Erheed. Titionly!\nab\nab", 4: rows[3][1]}
    docs = frame(spark, rows)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    assert edits(line, near) == 3 and edits(line, rows[3][1]) > 3
    for out in (op10_line_dedup(spark, str(tmp_path)), corpus_pipeline.line_dedup(spark, docs, str(tmp_path))):
        assert {r["doc_id"]: r["text"] for r in out.collect()} == want


def test_line_dedup_of_awkward_rows(spark):
    rows = [(i, t) for i, t in awkward() if t is None or len(t) < 60_000]
    out = linedup.dedup_lines(frame(spark, rows))
    assert out.count() == len(rows)
    assert sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=str) == expected_lines(rows, 1, 20)


def test_white_space_is_taken_from_the_ends_of_lines_that_have_some(spark):
    """As btrim does it, but a line without white space at its ends is not walked through: neither is it in the filter on lengths."""
    ends = ["", " ", "\t", "\r", " \t\r ", " ", "\x0b"]
    texts = [a + mid + b for a in ends for b in ends for mid in ("", "x", "a line", "é 你\tb")] + [None]
    rows = frame(spark, list(enumerate(texts))).select("text", linedup.trimmed(F.col("text")).alias("t"), F.btrim("text", F.lit(" \t\r")).alias("want")).collect()
    assert len(rows) == len(texts) and all(r["t"] == r["want"] for r in rows)
    plan = linedup.lines(frame(spark, [(1, "a")]), "doc_id", "text", 4)._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "trim(" in plan and plan.count("trim(") == plan.count("then trim(")


def test_probes_of_plain_lines_are_not_looked_up(spark):
    """Of the 8 or more keys that each line probes with, those of lines without a hot key pass by the table of hot keys."""
    reps = Stages(spark, "test").write(spark.createDataFrame([(prose(k, 6),) for k in range(40)], "norm string").withColumns({"h1": F.xxhash64("norm"), "n": F.length("norm")}))
    plan = linedup.line_links(reps, 3)._jdf.queryExecution().optimizedPlan().toString()
    assert "hot_key" not in plan


def test_no_lines(spark):
    assert linedup.dedup_lines(frame(spark, []).limit(0)).count() == 0


def test_banded_automaton(spark):
    rng = random.Random(9)
    pairs = [("", ""), ("a", ""), ("", "abc"), ("kitten", "sitting")]
    for _ in range(200):
        a = "".join(rng.choice("abé") for _ in range(rng.randint(0, 9)))
        b = "".join(rng.choice("abé") for _ in range(rng.randint(0, 9))) if rng.random() < 0.5 else a[1:] + rng.choice(["", "a", "bb"])
        pairs.append((a, b))
    df = spark.createDataFrame([(a, b, list(a), list(b)) for a, b in pairs], "a string, b string, ca array<string>, cb array<string>")
    for k in range(5):
        rows = df.select("a", "b", linedup.within_edits(F.col("ca"), F.col("cb"), k).alias("w")).collect()
        assert all(r["w"] == (edits(r["a"], r["b"]) <= k) for r in rows)


@pytest.mark.parametrize("max_edits", [0, 1, 3, 4])
def test_line_links_lose_no_pair(spark, max_edits):
    """Every pair within max_edits is a candidate and passes each filter, at the borders of the ranges of lengths too;
    what leaves the verification is exact."""
    rng = random.Random(max_edits)

    def mutate(line):
        for _ in range(rng.randint(0, max_edits)):
            at = rng.choice([0, len(line) - 1, rng.randrange(len(line))])
            line = rng.choice([line[:at] + line[at + 1:], line[:at] + rng.choice("eqé你") + line[at:], line[:at] + rng.choice("eqé") + line[at + 1:]])
        return line

    groups = [["".join(rng.choice("etaoxé ") for _ in range(n))] for n in (12, 15, 16, 17, 20, 31, 32, 33, 63, 64, 65, 127, 128, 130, 255, 257, 512)]
    for group in groups:
        group += [mutate(group[0]) for _ in range(8)]
    rows = [(g, line) for g, group in enumerate(groups) for line in set(group) if len(line) >= 8]
    stages = Stages(spark, "test")
    reps = stages.write(spark.createDataFrame(rows, "g int, norm string").withColumns({"h1": F.xxhash64("norm"), "n": F.length("norm")}))
    found = {(r["a"], r["b"]) for r in linedup.line_links(reps, max_edits).collect()}
    ends = [reps.select("g", F.col("h1").alias(k), F.col("norm").alias(f"norm_{k}")) for k in "ab"]
    pairs = stages.write(ends[0].join(ends[1], "g").where("a < b").withColumn("d", F.levenshtein("norm_a", "norm_b")))
    near = pairs.select("a", "b", "d", linedup.pieces_in_place(F.col("norm_a"), F.col("norm_b"), max_edits).alias("pieces")).where(F.col("d") <= max_edits).collect()
    assert all((r["a"], r["b"]) in found and r["pieces"] for r in near)
    assert len(near) >= 50 or not max_edits
    middles = stages.write(linedup.unlike_middles(pairs).join(pairs.select("a", "b", "d"), ["a", "b"]))
    judged = middles.select("d", linedup.within_edits(F.col("chars_a"), F.col("chars_b"), max_edits).alias("w")).collect()
    assert len(judged) == pairs.count() and all(r["w"] == (r["d"] <= max_edits) for r in judged)


@pytest.mark.parametrize("max_edits", [0, 1, 3, 4])
def test_keys_of_many_lines_lose_no_pair(spark, monkeypatch, max_edits):
    """With every key taken as one of very many lines, each pair within max_edits is still found."""
    monkeypatch.setattr(linedup, "PART", 1)
    monkeypatch.setattr(linedup, "PART_LINES", 2)
    rng = random.Random(50 + max_edits)
    lines = set()
    for n in (9, 16, 17, 31, 33, 64, 66, 130, 256):
        base = "".join(rng.choice("etaoxé ") for _ in range(n))
        for _ in range(14):
            line = base
            for _ in range(rng.randint(0, max_edits)):
                at = rng.choice([0, len(line) - 1, rng.randrange(len(line))])
                line = rng.choice([line[:at] + line[at + 1:], line[:at] + rng.choice("eqé你") + line[at:], line[:at] + rng.choice("eqé") + line[at + 1:]])
            lines.add(line)
    reps = Stages(spark, "test").write(spark.createDataFrame([(x,) for x in sorted(lines)], "norm string").withColumns({"h1": F.xxhash64("norm"), "n": F.length("norm")}))
    found = {(r["a"], r["b"]) for r in linedup.line_links(reps, max_edits).collect()}
    rows = [(r["h1"], r["norm"]) for r in reps.collect()]
    near = {(min(a, b), max(a, b)) for k, (a, x) in enumerate(rows) for b, y in rows[:k] if abs(len(x) - len(y)) <= max_edits and edits(x, y) <= max_edits}
    assert near <= found and (near or not max_edits)


def test_near_copies_of_one_template_are_few_candidates(spark):
    """Lines that share a quarter of a template but are far apart are not listed as pairs; the near ones are linked."""
    rng = random.Random(8)
    words = prose(3, 40).split()
    lines = {" ".join("".join(rng.choice("etaoinshr") for _ in range(6)) if rng.random() < 0.12 else w for w in words) for _ in range(400)}
    first = min(lines)
    lines |= {first[:40] + "zz" + first[42:], first[:-1]}
    reps = Stages(spark, "test").write(spark.createDataFrame([(x,) for x in sorted(lines)], "norm string").withColumns({"h1": F.xxhash64("norm"), "n": F.length("norm")}))
    hashes = {r["norm"]: r["h1"] for r in reps.collect()}
    found = {(r["a"], r["b"]) for r in linedup.line_links(reps, 3).collect()}
    near = {tuple(sorted((hashes[first], hashes[x]))) for x in (first[:40] + "zz" + first[42:], first[:-1])}
    assert near <= found and len(found) < 5_000


def test_line_dedup_is_native(spark):
    plan = linedup.dedup_lines(frame(spark, [(1, prose(1, 20)), (2, prose(1, 20))]))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


# ---------------------------------------------------------------- benchmark

def expected_leaks(docs, items):
    def runs(text):
        words = (text or "").encode().lower().split()
        return words, [tuple(words[k:k + 5]) for k in range(len(words) - 4)]

    from collections import Counter
    out = set()
    for doc, text in docs:
        words, own = runs(text)
        for item, other in items:
            asked, theirs = runs(other)
            if not asked or not words:
                continue
            if len(asked) < 5:
                if any(words[k:k + len(asked)] == asked for k in range(len(words) - len(asked) + 1)):
                    out.add((doc, item))
                continue
            n, want = min(len(theirs), len(own)), Counter(theirs)
            for k in range(len(own) - n + 1 if own else 0):
                both = sum((Counter(own[k:k + n]) & want).values())
                if both / (len(theirs) + n - both) >= 0.75:
                    out.add((doc, item))
    return out


@pytest.mark.parametrize("held", [2_000_000, 100])
def test_leaks_by_brute_force(spark, monkeypatch, held):
    monkeypatch.setattr(decontam, "HELD_WORDS", held)
    monkeypatch.setattr(decontam, "STARTS", 16)
    items = [(i, prose(i, 10 + 3 * i)) for i in range(12)] + [(20, None), (21, ""), (22, "very short item"), (None, prose(50, 30)), (23, prose(3, 19)), (24, "w w w w w w w w w w")]
    rng = random.Random(2)
    docs = []
    for k in range(60):
        item = items[k % 12][1]
        docs.append((k, prose(100 + k, rng.randint(0, 80)) + " " + edited(item, k, k % 3) + " " + prose(200 + k, rng.randint(0, 80))))
    docs += [(200, prose(50, 30)), (201, "a VERY Short item here"), (202, prose(11, 43)[:-20]), (203, "w " * 200), (204, prose(5, 25) + "\n" + prose(6, 28))]
    docs += [(300 + k, prose(700 + k, 100)) for k in range(20)]
    table = spark.createDataFrame(items, "item_id long, text string")
    got = decontam.find(frame(spark, docs), table)
    assert {(r["doc_id"], r["item_id"]) for r in got.collect()} == expected_leaks(docs, items)
    kept = {r["doc_id"] for r in decontam.decontaminate(frame(spark, docs), table).collect()}
    assert kept == {d for d, _ in docs} - {d for d, _ in expected_leaks(docs, items)}


def test_leaks_in_awkward_rows(spark):
    docs = frame(spark, awkward())
    items = spark.createDataFrame([(1, prose(2, 200)), (1, prose(2, 200)), (2, "one")], "item_id long, text string")
    got = [(r["doc_id"], r["item_id"]) for r in decontam.find(docs, items).collect()]
    assert sorted(got) == sorted([(8, 1)] * 4 + [(9, 1)] * 2 + [(4, 2), (5, 2)])
    assert decontam.decontaminate(docs, items).columns == docs.columns
    assert decontam.find(docs, items.limit(0)).count() == 0 and decontam.find(docs.limit(0), items).count() == 0


def test_blocks_guarantee_the_radius():
    rng = np.random.default_rng(3)
    items = decontam.Items([0], [rng.integers(0, 2**63, 40, dtype=np.uint64)])
    for flips in range(decontam.RADIUS + 1):
        bits = np.unpackbits(items.prints[0])
        bits[rng.choice(64, flips, replace=False)] ^= 1
        at, _ = items.candidates(np.packbits(bits)[None, :])
        assert len(at) == 1


# ---------------------------------------------------------------- vectors

def expected_vectors(rows, cosine):
    usable = [(k, i, np.array(v, float), label) for k, (i, v, label) in enumerate(rows)
              if label is not None and v and None not in v and np.isfinite(np.array(v, float)).all() and np.any(v)]
    pairs, n = [], defaultdict(int)
    for a in range(len(usable)):
        for b in range(a):
            x, y = usable[a], usable[b]
            if x[3] == y[3] and len(x[2]) == len(y[2]) and x[2] @ y[2] / np.linalg.norm(x[2]) / np.linalg.norm(y[2]) >= cosine:
                pairs.append((y[0], x[0]))
                n[x[0]] += 1
                n[y[0]] += 1
    label = closed(range(len(rows)), pairs)
    groups = defaultdict(list)
    for k in range(len(rows)):
        groups[label[k]].append(rows[k][0])
    out = []
    for k, (i, _, _) in enumerate(rows):
        ids = [x for x in groups[label[k]] if x is not None]
        component = min(ids) if ids else None
        out.append((i, n[k], component, i == component))
    return out


def test_vectors_by_brute_force(spark, monkeypatch):
    monkeypatch.setattr(vectors, "CHUNK", 16)
    rng = np.random.default_rng(8)
    rows = []
    for c in range(12):
        centre = rng.standard_normal(16)
        rows += [(1000 * c + k, (centre + 0.2 * rng.standard_normal(16)).tolist(), c % 3) for k in range(25)]
    rows += [(50_000 + k, [1.0] * 16, 1) for k in range(40)]  # copies
    rows += [(60_000, None, 1), (60_001, [], 1), (60_002, [0.0] * 16, 1), (60_003, [float("nan")] + [1.0] * 15, 1), (60_004, [None] + [1.0] * 15, 1),
             (60_005, [1.0] * 16, None), (60_006, [2.0] * 16, 1), (60_007, [1.0, 2.0], 1), (60_008, [2.0, 4.0], 1), (None, [1.0] * 16, 1), (60_009, [3.0], 2), (60_010, [1e-30] * 16, 1)]
    rows += [rows[0], rows[30]]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("rid", F.lit(1)).withColumn("n", F.lit("x"))
    got = sorted((tuple(r) for r in vectors.near_vectors(docs).collect()), key=str)
    want = sorted(expected_vectors(rows, 0.93), key=str)
    links = sum(w[1] for w in want)
    assert len(got) == len(want) and sum(g[1] for g in got) >= 0.97 * links
    for g, w in zip(got, want):
        assert g[0] == w[0] and g[1] <= w[1]
    assert sum(g != w for g, w in zip(got, want)) <= 0.05 * len(rows)


def test_visits_are_the_nearest_cells():
    rng = np.random.default_rng(1)
    index = vectors.Index(rng.standard_normal((9, 4)), rng.standard_normal((9, 4)), 20)
    points = rng.standard_normal((30, 8))
    got = vectors.traverse(index, points, 20)
    d = vectors.distances(points[:, :4], index.first)[:, :, None] + vectors.distances(points[:, 4:], index.second)[:, None, :]
    for i in range(30):
        assert np.allclose(np.sort(d[i].ravel())[:20], d[i].ravel()[got[i]])


def test_no_vectors(spark):
    docs = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert vectors.near_vectors(docs).count() == 0


def test_recall_on_the_table(spark):
    from attain.llm.queries import op8_multi_index

    folder = "/root/testdata/sf0.1"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    want = 0
    for label in {r[2] for r in rows if r[2] is not None}:
        v = np.array([r[1] for r in rows if r[2] == label and r[1]], float)
        v /= np.linalg.norm(v, axis=1, keepdims=True)
        want += int((v @ v.T >= 0.93).sum() - len(v))
    assert sum(r["n_links"] for r in op8_multi_index(spark, folder).collect()) >= 0.9 * want


def test_very_many_lines_of_one_document(spark):
    n = 20_000
    texts = [(1, "\n".join(["the same line of more than twenty characters"] * n)), (2, "\n".join(f"line {i} x {i * 7919 % n}" if i % 2 else "again and again" for i in range(n)))]
    rows = {r["doc_id"]: r for r in linedup.dedup_lines(frame(spark, texts), max_edits=0, exact_chars=linedup.EXACT_CHARS).collect()}
    assert rows[1]["text"] == texts[0][1].split("\n")[0] and rows[1]["n_dropped"] == n - 1 and rows[1]["n_lines"] == n
    assert rows[2]["text"].split("\n")[:4] == texts[1][1].split("\n")[:2] + texts[1][1].split("\n")[3:6:2] and rows[2]["n_dropped"] == n // 2 - 1
