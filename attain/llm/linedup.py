"""Line deduplication by a segment-partition edit join, in DataFrame and SQL functions only.

Lines within max_edits edits of each other are linked, links are closed to classes, and of each class the first
line in (document id, line number) order stays.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attain.llm.common import Stages, components, filter_rows, maybe_in

NO_ID = (1 << 63) - 1
#: What the query and the pipeline take: edits between near copies, and the characters from which exact repeats go.
EDITS, EXACT_CHARS = 3, 4
#: A key is taken as one of very many lines if PART_LINES of one line in PART have it.
PART, PART_LINES = 8, 4
LETTERS = " etaoinsrhldcumfpgwby"
WHITE = " \t\r"


def trimmed(line: Column) -> Column:
    """The line without white space at its ends; only a line that has some is walked through."""
    at_ends = F.lit(False)
    for white in WHITE:
        at_ends = at_ends | F.startswith(line, F.lit(white)) | F.endswith(line, F.lit(white))
    return F.when(at_ends, F.btrim(line, F.lit(WHITE))).otherwise(line)


def lines(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """Lines of at least min_chars characters in normal form, with two hashes of it and their place."""
    cut = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("text_key"),
                      F.posexplode(F.split(F.lower(text_col), "\n")).alias("line_no", "line"))
    norm = trimmed(F.col("line"))
    place = F.coalesce("id", F.lit(NO_ID)).cast("decimal(20,0)") * F.lit(1 << 31).cast("decimal(11,0)") + F.col("line_no").cast("decimal(10,0)")
    return (cut.where((F.octet_length("line") >= min_chars) & (F.length(norm) >= min_chars))
            .select("id", "text_key", "line_no", norm.alias("norm"), place.cast("decimal(33,0)").alias("place"))
            .select("*", F.xxhash64("norm").alias("h1"), F.xxhash64(F.lit("second"), "norm").alias("h2")))


def length_base(length: Column) -> Column:
    """The lower edge of the range of lengths that are cut alike: three leading bits of the length stay."""
    unit = F.length(F.bin(length)) - 3
    return F.when(length < 16, length).otherwise(F.call_function("shiftleft", F.call_function("shiftright", length, unit), unit)).cast("int")


def piece(start: Column, size: Column) -> Column:
    return F.substring("norm", (start + 1).cast("int"), size.cast("int"))


def one_byte_chars() -> Column:
    """The line in UTF-8 if each of its characters is one byte, else null."""
    return F.when(F.octet_length("norm") == F.col("n"), F.col("norm").cast("binary"))


def piece_bytes(start: Column, size: Column, bytes: Column) -> Column:
    """The piece in UTF-8; where each character is one byte, none is counted from the start of the line."""
    return (F.when(bytes.isNotNull(), F.substring(bytes, (start + 1).cast("int"), size.cast("int")))
            .otherwise(piece(start, size).cast("binary")))


def segment(i: Column, parts: int) -> Column:
    """Start (from 0) of segment i (from 0) of size characters in a line of n characters.

    The first half of the segments is counted from the start of the line and the second half from its end, so that
    lines of several lengths are cut alike; characters in the middle may be in no segment. Of two lines within
    parts - 1 edits, some segment i is untouched with at most i edits before and at most parts - 1 - i behind it.
    """
    return F.when(2 * i < parts, i * F.col("size")).otherwise(F.col("n") - (parts - i) * F.col("size"))


def placed(lines: DataFrame, max_edits: int, shifted: bool) -> DataFrame:
    """lines, given base, once for each segment and, if asked, each shift that it allows, with i, size and the key."""
    parts = max_edits + 1
    slack = [i if 2 * i < parts else parts - 1 - i for i in range(parts)]
    cuts = [F.struct(F.lit(i).alias("i"), F.lit(shift).alias("shift")) for i in range(parts) for shift in (range(-slack[i], slack[i] + 1) if shifted else [0])]
    # the cuts are rows, not one long expression: that is too long to be compiled to machine code
    wide = lines.withColumns({"size": (F.col("base") / parts).cast("int"), "bytes": one_byte_chars()}).select("*", F.explode(F.array(*cuts)).alias("cut"))
    start = segment(F.col("cut.i"), parts) + F.col("cut.shift")
    return (wide.withColumn("start", start.cast("int")).where((F.col("start") >= 0) & (F.col("start") + F.col("size") <= F.col("n")))
            .withColumns({"i": F.col("cut.i"), "key": F.xxhash64("base", "cut.i", piece_bytes(F.col("start"), F.col("size"), F.col("bytes")))}))


def index_lines(reps: DataFrame) -> DataFrame:
    return reps.withColumn("base", length_base(F.col("n")))


def probe_lines(reps: DataFrame, max_edits: int) -> DataFrame:
    """reps once for each base of the lines that are shorter by 0 to max_edits; lengths of one range share their keys."""
    bases = F.array_distinct(F.array(*[length_base(F.greatest(F.col("n") - less, F.lit(1))) for less in range(max_edits + 1)]))
    return reps.select("*", F.explode(bases).alias("base"))


def index_keys(reps: DataFrame, max_edits: int) -> DataFrame:
    """reps with the key of each of the max_edits + 1 segments of a line."""
    return placed(index_lines(reps), max_edits, shifted=False)


def probe_keys(reps: DataFrame, max_edits: int) -> DataFrame:
    """reps with keys of substrings of a line, one of which a line that is shorter by 0 to max_edits must have as a segment."""
    return placed(probe_lines(reps, max_edits), max_edits, shifted=True)


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with the value worked out once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def letter_counts(text: Column) -> Column:
    """How often each of LETTERS is in a text."""
    return bound(text, lambda t: F.transform(F.array(*[F.lit(c) for c in LETTERS]), lambda c: F.length(t) - F.length(F.replace(t, c, F.lit("")))))


def half_counts() -> Column:
    """Letter counts of the first and of the last characters of a line, as many as make half of its base."""
    half = (F.col("base") / 2).cast("int")
    return F.concat(letter_counts(piece(F.lit(0), half)), letter_counts(piece(F.col("n") - half, half)))


def letters_alike(a: Column, b: Column, max_edits: int) -> Column:
    """False only for letter counts of lines that are more than max_edits edits apart: an edit changes two counts by one at most,
    those of a line's start or those of its end.
    """
    apart = F.aggregate(F.zip_with(a, b, lambda x, y: F.abs(x - y)), F.lit(0), lambda total, x: total + x)
    return apart <= 2 * max_edits


def pieces_in_place(a: Column, b: Column, max_edits: int) -> Column:
    """False only for strings that are more than max_edits edits apart: of many pieces of a, an edit can spoil one,
    and the others are in b, shifted by max_edits at most."""
    parts, n = 4 * max(max_edits, 1), F.length(a).cast("long")
    found = F.lit(0)
    for i in range(parts):
        start, end = (n * i / parts).cast("int"), (n * (i + 1) / parts).cast("int")
        first = F.greatest(start - max_edits, F.lit(0))
        found = found + F.contains(F.substring(b, first + 1, end + max_edits - first), F.substring(a, start + 1, end - start)).cast("int")
    return found >= parts - max_edits


def shared_start(a: Column, b: Column) -> Column:
    """The number of equal characters at the start of both strings, or 2^18 - 1 if it is larger."""
    shorter = F.least(F.length(a), F.length(b))
    return F.aggregate(F.array(*[F.lit(1 << k) for k in range(17, -1, -1)]), F.lit(0), lambda n, more: F.when(
        (n + more <= shorter) & (F.substring(a, n + 1, more) == F.substring(b, n + 1, more)), n + more).otherwise(n))


def unlike_middles(pairs: DataFrame) -> DataFrame:
    """(a, b, chars_a, chars_b): the characters of norm_a and norm_b without what they share at both ends."""
    def rest(name: str) -> Column:
        return F.array_remove(F.split(F.substring(name, F.lit(1), F.length(name) - F.col("behind")), ""), "")

    ahead = pairs.select("a", "b", "norm_a", "norm_b", shared_start(F.col("norm_a"), F.col("norm_b")).alias("ahead"))
    ahead = ahead.select("a", "b", *[F.substring(c, F.col("ahead") + 1, F.length(c)).alias(c) for c in ("norm_a", "norm_b")])
    # turned once, not in each step
    turned = ahead.select("*", *[F.reverse(f"norm_{k}").alias(f"back_{k}") for k in ("a", "b")])
    behind = turned.select("a", "b", "norm_a", "norm_b", shared_start(F.col("back_a"), F.col("back_b")).alias("behind"))
    return behind.select("a", "b", rest("norm_a").alias("chars_a"), rest("norm_b").alias("chars_b"))


def within_edits(ca: Column, cb: Column, max_edits: int) -> Column:
    """Whether two strings, given as arrays of characters, are at most max_edits edits apart, by a banded bit-parallel
    automaton.

    The state holds max_edits + 1 words of 2 * max_edits + 1 bits, one bit for each diagonal of the band:
    word e has the diagonals that are reachable with e edits after the characters of a so far.
    """
    if not 0 <= max_edits <= 4:
        raise ValueError("the band fits into 64 bits for 0 to 4 edits")
    width, levels = 2 * max_edits + 1, max_edits + 1
    full = (1 << width) - 1
    last = F.size(cb) - F.size(ca) + max_edits  # the diagonal that ends in both strings

    def level(state: Column, e: int) -> Column:
        return F.shiftright(state, width * e).bitwiseAND(F.lit(full).cast("long"))

    def packed(words: list[Column]) -> Column:
        out = words[0]
        for e in range(1, levels):
            out = out.bitwiseOR(F.shiftleft(words[e], width * e))
        return out

    start = sum(((1 << (max_edits + 1 + e)) - (1 << max_edits)) << (width * e) for e in range(levels))

    def step(state: Column, i: Column) -> Column:
        same = F.lit(0).cast("long")
        for d in range(width):
            hit = F.get(cb, i + (d - max_edits)) == F.get(ca, i)
            same = same.bitwiseOR(F.when(hit, F.lit(1 << d).cast("long")).otherwise(F.lit(0).cast("long")))
        # nothing is reachable from an empty state, and the matches of a character are found once for all levels
        return F.when(state == 0, state).otherwise(bound(same, lambda same: moved(state, same)))

    def moved(state: Column, same: Column) -> Column:
        words: list[Column] = []
        for e in range(levels):
            now = level(state, e).bitwiseAND(same)
            if e:
                before = level(state, e - 1)
                now = now.bitwiseOR(before).bitwiseOR(F.shiftright(before, 1))
                now = now.bitwiseOR(F.shiftleft(words[e - 1], 1)).bitwiseAND(F.lit(full).cast("long"))
            words.append(now)
        return packed(words)

    walked = F.aggregate(F.when(F.size(ca) > 0, F.sequence(F.lit(0), F.size(ca) - 1)).otherwise(F.array().cast("array<int>")),
                         F.lit(start).cast("long"), step)
    reached = F.shiftright(walked, width * max_edits)
    return (F.abs(F.size(ca) - F.size(cb)) <= max_edits) & (F.call_function("shiftright", reached, last.cast("int")).bitwiseAND(F.lit(1).cast("long")) == 1)


def line_links(reps: DataFrame, max_edits: int) -> DataFrame:
    """Pairs (a, b) of line hashes, from (h1, norm, n), that hold every pair of lines within max_edits edits.

    Lines that share a segment in place and differ in length by max_edits at most are pairs. Keys that very many lines
    have are told by a part of the lines; lines that meet there must have like letters too, and those that share their
    start are taken by it alone. Which keys count as such changes what is compared, but loses no pair within max_edits.
    """
    stages = Stages(reps.sparkSession, "links")
    part = index_keys(reps.where(F.pmod("h1", F.lit(PART)) == 0), max_edits).groupBy("key").agg(F.count("*").alias("lines"))
    hot_keys = stages.write(filter_rows(part.where(F.col("lines") >= PART_LINES).select("key")))
    hot_lines = stages.write(filter_rows(maybe_in(index_keys(reps, max_edits).select("h1", "key"), "key", hot_keys).where("__in")
                                         .select(F.col("h1").alias("key"))))
    flagged = maybe_in(reps, "h1", hot_lines).withColumnRenamed("__in", "hot")
    less = F.col("n_b") - F.col("n")
    meet = (F.col("key") == F.col("key_b")) & less.between(0, max_edits) & ((less > 0) | (F.col("h1") < F.col("h1_b")))

    def other(df: DataFrame) -> DataFrame:
        return df.select(*[F.col(c).alias(f"{c}_b") for c in df.columns])

    index = index_keys(reps, max_edits).select("h1", "n", "key")
    lines = stages.write(flagged.where("hot").select("h1", "norm", "n"))
    # a line without a hot key as an index has no part in the second join: it meets hot keys here, and none of its keys is looked up
    probe = probe_keys(flagged.where("NOT hot"), max_edits).select("h1", "n", "key")
    probe = probe.unionByName(maybe_in(probe_keys(lines, max_edits), "key", hot_keys).where("NOT __in").select("h1", "n", "key"))
    plain = index.join(other(probe), meet).select("h1", "h1_b")
    start = F.xxhash64(piece_bytes(F.lit(0), F.col("size"), F.col("bytes")))
    hot = [maybe_in(placed(based.withColumn("letters", half_counts()), max_edits, shifted), "key", hot_keys).where("__in")
           .select("h1", "n", "key", "i", start.alias("start"), "letters") for based, shifted in ((index_lines(lines), False), (probe_lines(lines, max_edits), True))]
    once = (F.col("i") == 0) | (F.col("start") != F.col("start_b"))
    dense = hot[0].join(other(hot[1]), meet & once & letters_alike(F.col("letters"), F.col("letters_b"), max_edits)).select("h1", "h1_b")
    return plain.unionByName(dense).select(F.least("h1", "h1_b").alias("a"), F.greatest("h1", "h1_b").alias("b")).where("a <> b").distinct()


def repeated_lines(docs: DataFrame, stages: Stages, *, id_col: str = "doc_id", text_col: str = "text", max_edits: int = 1,
                   min_chars: int = 20, exact_chars: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Places of all lines, and (h1, h2, keep) of the lines that occur again or have a near copy; keep is the place of the one that stays."""
    written = lines(docs, id_col, text_col, min_chars if exact_chars is None else max(1, min(exact_chars, min_chars)))
    written = stages.write(written.withColumn("n", F.length("norm")))
    classes = stages.write(written.groupBy("h1", "h2").agg(F.count("*").alias("times"), F.min("place").alias("first")))
    again = filter_rows(classes.where("times > 1").select(F.col("h1").alias("key")))
    flagged = maybe_in(written, "h1", again)
    # one line of each class: lines that occur once come straight from what was written, the others by their first place
    columns = ("h1", "norm", "n")
    # lines that occur once may be __in too, so their classes are taken by the same filter
    firsts = maybe_in(classes, "h1", again).where("__in").select(F.col("h1").alias("c1"), F.col("h2").alias("c2"), "first")
    others = stages.write(flagged.where("__in").join(firsts, (F.col("h1") == F.col("c1")) & (F.col("h2") == F.col("c2")) & (F.col("place") == F.col("first")))
                          .select(*columns))
    reps = flagged.where("NOT __in").select(*columns).unionByName(others)
    pairs = stages.write(line_links(reps.where(F.col("n") >= min_chars), max_edits))
    wanted = filter_rows(pairs.select(F.explode(F.array("a", "b")).alias("key")))
    ends = pairs.select(F.explode(F.array("a", "b")).alias("end")).distinct()
    texts = stages.write(maybe_in(reps, "h1", wanted).where("__in").join(ends, F.col("h1") == F.col("end"), "left_semi")
                         .select("h1", "norm").distinct().withColumn("letters", letter_counts(F.col("norm"))))
    left, right = (texts.select(F.col("h1").alias(k), F.col("norm").alias(f"norm_{k}"), F.col("letters").alias(f"letters_{k}")) for k in ("a", "b"))
    alike = pairs.join(left, "a").join(right, "b").where(letters_alike(F.col("letters_a"), F.col("letters_b"), max_edits))
    close = alike.where(pieces_in_place(F.col("norm_a"), F.col("norm_b"), max_edits))
    middles = stages.write(unlike_middles(close))
    edges = middles.where(within_edits(F.col("chars_a"), F.col("chars_b"), max_edits)).select("a", "b")
    linked = components(edges, stages)
    near = (classes.join(linked, F.col("h1") == F.col("id")).select("h1", "h2", "first", "component"))
    keeps = near.groupBy("component").agg(F.min("first").alias("keep"))
    near = stages.write(near.join(keeps, "component").select("h1", "h2", "keep"))
    exact = classes.where("times > 1").join(near.select("h1", "h2"), ["h1", "h2"], "left_anti")
    return written.select("id", "text_key", "line_no", "h1", "h2", "place"), stages.write(near.unionByName(exact.select("h1", "h2", F.col("first").alias("keep"))))


def dedup_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", max_edits: int = 1, min_chars: int = 20,
                exact_chars: int | None = None) -> DataFrame:
    """The documents with repeated and near repeated lines taken out, and n_lines and n_dropped.

    Lines are compared lower-cased and without white space at their ends. Lines of fewer than min_chars characters
    always stay, unless exact_chars is given: then those of exact_chars or more go where they repeat exactly, and only
    shorter ones (and blank ones) always stay. Of lines of min_chars or more, those within max_edits (0 to 4) edits are linked, linked lines form a class, and the first line of
    a class in (id, line number) order stays; null ids come last. Rows that share their id and text are one document: each keeps
    the same lines. A null text stays null with no lines, an empty text has one empty line. A document that loses
    every line stays with an empty text. Input columns n_lines and n_dropped are replaced. An empty table gives no
    rows. Lines are told apart by 128-bit hashes; links between different lines are confirmed on the lines.
    """
    spark = docs.sparkSession
    stages = Stages(spark, "lines")
    places, repeated = repeated_lines(docs, stages, id_col=id_col, text_col=text_col, max_edits=max_edits, min_chars=min_chars,
                                      exact_chars=exact_chars)
    found = repeated.select(F.col("h1").alias("r1"), F.col("h2").alias("r2"), "keep")
    kept = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    among = maybe_in(places, "h1", filter_rows(repeated.select(F.col("h1").alias("key"))))
    lost = stages.write(among.where("__in").join(found, (F.col("h1") == F.col("r1")) & (F.col("h2") == F.col("r2")))
                        .where("place <> keep").select("id", "text_key", "line_no").distinct()
                        .groupBy("id", "text_key").agg(F.collect_list("line_no").alias("lost")))
    hit = filter_rows(lost.select(F.xxhash64("id", "text_key").alias("key")))
    rows = docs.select(F.struct(*kept).alias("row"), F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("text_key"))
    rows = maybe_in(rows.withColumn("hit", F.xxhash64("id", "text_key")), "hit", hit)
    losers = lost.select(F.col("id").alias("lost_id"), F.col("text_key").alias("lost_key"), "lost")
    touched = (rows.where("__in").join(losers, F.col("id").eqNullSafe(F.col("lost_id")) & (F.col("text_key") == F.col("lost_key")), "left")
               .select("row", "lost"))
    both = touched.unionByName(rows.where("NOT __in").select("row", F.lit(None).cast("array<int>").alias("lost")))
    text, split = F.col("row")[text_col], F.split(F.col("row")[text_col], "\n")
    def stay(lines):  # bound once: every place that is not lost, taken by its number
        return F.transform(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("lost")), lambda i: F.get(lines, i))

    rest = F.get(F.transform(F.array(split), stay), F.lit(0))
    new = F.when(F.col("lost").isNull(), text).otherwise(F.array_join(rest, "\n"))
    return both.select(*[new.alias(c) if c == text_col else F.col("row")[c].alias(c) for c in kept],
                       F.when(text.isNull(), 0).otherwise(F.size(split)).alias("n_lines"),
                       F.when(F.col("lost").isNull(), 0).otherwise(F.size("lost")).alias("n_dropped"))
