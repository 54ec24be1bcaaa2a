"""Token counts: texts are encoded in batches inside Arrow functions and only lengths come back.

Long texts are split at boundaries that no token can span, so the counts of the parts add up to that of the whole.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attain.llm.common import give_back

#: White space in a row that tiktoken is trusted with.
MOST_BLANKS = 100_000
#: Bytes of text that are encoded at once, and characters after which a text is split.
BATCH_BYTES = 1 << 18
PART_CHARS = 1 << 16

LETTER = "A-Za-zÀ-ÖØ-öø-ÿ一-鿋ぁ-ゖァ-ヺ가-힣"
#: After a visible character and before white space: no pattern of words spans this place.
BEFORE_SPACE = r"(?<=[^\s\x1c-\x1f᠎​])(?=[ \t\r\n])"
#: Letters before something that is surely none end a word; between letters the vocabulary decides.
AFTER_LETTER = rf"(?<=[{LETTER}])(?=[!-@\[-`{{-~。、，！？；：])"
INSIDE_WORD = rf"(?<=[{LETTER}][{LETTER}])(?=[{LETTER}])"

PLAIN_NORMALIZERS = {"NFC", "NFD", "NFKC", "NFKD", "Lowercase"}
WORD_SPLITTERS = {"Whitespace", "WhitespaceSplit", "BertPreTokenizer"}


def byte_alphabet() -> dict[str, int]:
    """The printable stand-ins of the 256 bytes in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def _steps(spec: dict | None, name: str) -> list[dict]:
    """A normalizer or pre-tokenizer as the list of its steps."""
    if spec is None:
        return []
    return [s for part in spec[name] for s in _steps(part, name)] if spec["type"] == "Sequence" else [spec]


class Library:
    """One tokenizer file with its own library, and the places where its texts may be split.

    `.json` files go through tokenizers, `.model` files through sentencepiece. special says whether the strings of
    added tokens inside a text become their ids (the default of tokenizers) or are ordinary text.
    """

    def __init__(self, path: str, special: bool = True):
        self.path, self.special = path, special
        if path.endswith(".json"):
            os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
            from tokenizers import Tokenizer

            self.model = Tokenizer.from_file(path)
            self.model.no_truncation()
            self.model.no_padding()
            self.model.encode_special_tokens = not special
            with open(path, encoding="utf-8") as f:
                self._json_cuts(json.load(f))
            self.encode = self._encode_json
        elif path.endswith(".model"):
            import sentencepiece

            self.model = sentencepiece.SentencePieceProcessor(model_file=path)
            self._model_cuts()
            self.encode = self._encode_model
        else:
            raise ValueError(f"neither a .json nor a .model file: {path}")

    def _json_cuts(self, spec: dict) -> None:
        added = spec.get("added_tokens", [])
        self.specials = [x["content"] for x in added] if self.special else []
        normal, splits = _steps(spec.get("normalizer"), "normalizers"), _steps(spec.get("pre_tokenizer"), "pretokenizers")
        plain = all(s["type"] in PLAIN_NORMALIZERS or (s["type"] == "Replace" and s["pattern"] == {"Regex": r"\s+"} and s["content"] == " ")
                    for s in normal)
        byte_words = any(s["type"] == "ByteLevel" and s.get("use_regex", True) for s in splits)
        # a pattern that takes out runs of letters, digits or other visible characters leaves white space between words
        words = byte_words or any(s["type"] in WORD_SPLITTERS or
                                  (s["type"] == "Split" and s.get("invert") and s["behavior"] == "Removed"
                                   and s["pattern"].get("Regex", "").endswith(r"[^\s\p{L}\p{N}]+")) for s in splits)
        odd = any(x.get(k) for x in added for k in ("single_word", "lstrip", "rstrip")) or any(re.search(r"\s", x) for x in self.specials)
        self.pattern, self.pairs = None, None
        if plain and words and not odd:
            self.pattern = re.compile(BEFORE_SPACE)
            if byte_words and not normal:
                byte = byte_alphabet()
                self.pairs = {(byte[a], byte[b]) for token in spec["model"]["vocab"] for a, b in zip(token, token[1:])
                              if a in byte and b in byte}
                self.pattern = re.compile(f"{BEFORE_SPACE}|{AFTER_LETTER}|{INSIDE_WORD}")
                self.letters = re.compile(f"[{LETTER}]")

    def _model_cuts(self) -> None:
        m = self.model
        pieces = [m.id_to_piece(i) for i in range(m.vocab_size())]
        plain = m.normalize("ﬁ ２  x\n") == "▁ﬁ▁２▁▁x\n" and m.encode("\nab", out_type=str)[:2] == ["▁", "<0x0A>"]
        self.specials = []
        # no piece may join two characters that are neighbours in no piece; a line break has bytes of its own
        self.pairs = {p[i:i + 2] for p in pieces for i in range(len(p) - 1)} if plain and not any("\n" in p for p in pieces) else None
        self.pattern = None

    def _encode_json(self, texts: list[str], first: list[bool]) -> list[list[int]]:
        return [e.ids for e in self.model.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_model(self, texts: list[str], first: list[bool]) -> list[list[int]]:
        """Only the first part of a text gets the space that the library adds: before others a line break takes it."""
        found = self.model.encode([t if at_start else "\n" + t for t, at_start in zip(texts, first)], num_threads=1)
        return [ids if at_start else ids[2:] for ids, at_start in zip(found, first)]

    def count(self, texts: list[str], first: list[bool]) -> list[int]:
        if self.path.endswith(".json"):
            return [len(e) for e in self.model.encode_batch_fast(texts, add_special_tokens=False)]
        return [len(ids) for ids in self.encode(texts, first)]

    def next_cut(self, text: str, at: int) -> int:
        """The first place from at on where text may be split, its end if there is none."""
        if self.path.endswith(".model"):
            if self.pairs is None:
                return len(text)
            for p in range(max(at, 1), len(text)):
                if (text[p - 1] + text[p]).replace(" ", "▁") not in self.pairs:
                    return p
            return len(text)
        if self.pattern is None:
            return len(text)
        at = max(at, 1)
        while found := self.pattern.search(text, at):
            p = found.start()
            if self._holds(text, p):
                return p
            at = p + 1
        return len(text)

    def _holds(self, text: str, p: int) -> bool:
        if self.pairs is not None and self.letters.match(text, p) and (text[p - 1].encode()[-1], text[p].encode()[0]) in self.pairs:
            return False  # inside a word that a token may span
        return not any(s in text[max(0, p - len(s) + 1):p + len(s) - 1] for s in self.specials)

    def parts(self, text: str, chars: int) -> Iterator[str]:
        """text in order, in parts of chars characters and what it takes to the next safe place."""
        at = 0
        while len(text) - at > chars:
            end = self.next_cut(text, at + chars)
            yield text[at:end]
            at = end
        if at < len(text) or not text:
            yield text[at:]


_libraries: dict[tuple[str, bool], Library] = {}


def library(path: str, special: bool = True) -> Library:
    """The tokenizer of a file, loaded once in each worker."""
    if (path, special) not in _libraries:
        _libraries[path, special] = Library(path, special)
    return _libraries[path, special]


_encoders: dict[tuple[str, bool], Callable[[str], list[int]]] = {}


def encoder(path: str, special: bool = False) -> Callable[[str], list[int]]:
    """text -> ids by the vocabulary of a byte-level tokenizers file; strings of its added tokens become their ids if
    special, as in the library by default, and are ordinary text otherwise.

    tiktoken does the merging: the same ids as the tokenizers library (tested), four times as fast. Texts with more than
    MOST_BLANKS blanks in a row, on which its regular expressions fail from some hundred thousand on, go to the tokenizers
    library, as do files that do not split words by bytes.
    """
    if (path, special) not in _encoders:
        import tiktoken
        from public_tokenizers import PATTERN

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        added = {x["content"]: x["id"] for x in spec.get("added_tokens", [])}
        if any(x.get(k) for x in spec.get("added_tokens", []) for k in ("single_word", "lstrip", "rstrip")):
            raise ValueError("added tokens that take in their surroundings are not supported")
        exact = library(path, special)

        def slow(text: str) -> list[int]:
            return exact.encode([text], [True])[0]

        byte_level = spec.get("normalizer") is None and (spec.get("pre_tokenizer") or {}).get("type") == "ByteLevel"
        if byte_level:
            byte = byte_alphabet()
            ranks = {bytes(byte[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in added}
            plain = tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
            apart = re.compile("(" + "|".join(re.escape(x) for x in sorted(added, key=len, reverse=True)) + ")") if special and added else None

            def words(text: str) -> list[int]:
                blanks = len(text) > MOST_BLANKS and any(m.end() - m.start() > MOST_BLANKS for m in re.finditer(r"\s{2,}", text))
                return slow(text) if blanks else plain(text)

            def encode(text: str) -> list[int]:
                if apart is None or not any(x in text for x in added):
                    return words(text)
                return [i for k, part in enumerate(apart.split(text)) for i in ([added[part]] if k % 2 else words(part))]

            _encoders[path, special] = encode
        else:
            _encoders[path, special] = slow
    return _encoders[path, special]


def lengths(texts: pa.Array, lib: Library, batch_bytes: int, part_chars: int) -> np.ndarray:
    """Tokens of each text; parts of different texts share a call, so that calls have about batch_bytes bytes."""
    out = np.zeros(len(texts), np.int64)
    rows, waiting, first, size = [], [], [], 0

    def flush():
        np.add.at(out, rows, lib.count(waiting, first))
        rows.clear(), waiting.clear(), first.clear()

    for row in range(len(texts)):
        text = texts[row].as_py()
        if not text:
            continue
        at_start = True
        for part in lib.parts(text, part_chars):
            rows.append(row), waiting.append(part), first.append(at_start)
            at_start = False
            size += len(part) if part.isascii() else len(part.encode())
            if size >= batch_bytes:
                flush()
                size = 0
    if rows:
        flush()
    return out


def token_count(text: Column, path: str, *, batch_bytes: int = BATCH_BYTES, part_chars: int = PART_CHARS) -> Column:
    """Tokens of a string column by a tokenizer file; null counts as empty."""

    @F.arrow_udf("long")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        lib = library(path)
        for texts in batches:
            yield pa.array(lengths(texts, lib, batch_bytes, part_chars))
        give_back()

    return count(text)


def count_tokens(docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text", limit: int = 1024,
                 count: Callable[..., Column] = token_count) -> DataFrame:
    """One row per row of docs: its id, n_bytes (UTF-8), n_tokens, and whether these are more than limit.

    Whole texts count as the tokenizer's own library encodes them, without begin, end or added special tokens; strings
    of special tokens inside a text are handled as by its default. Null and empty texts have no bytes and no tokens. Ids
    are carried as they are, null or repeated, one row for each row; other columns are ignored, whatever their names.
    Nothing is ordered, so there are no ties. A very long text is split where no token can span the cut; a run without
    such a place (a million equal letters) is encoded whole. An empty table gives no rows. One pass, no shuffle.
    """
    text = F.col(text_col)
    rows = docs.select(F.col(id_col), F.octet_length(F.coalesce(text, F.lit(""))).cast("long").alias("__bytes"), count(text, path).alias("__tokens"))
    return rows.select(F.col(id_col), F.col("__bytes").alias("n_bytes"), F.col("__tokens").alias("n_tokens"),
                       (F.col("__tokens") > limit).alias("over_limit"))
