"""Token counts with a whole-token shortcut.

Byte-level BPE merges inside pre-tokens only. Most pre-tokens are vocabulary
strings whose merges end in that one entry. ``prove_whole`` encodes the whole
vocabulary once and keeps the strings that come back as their own single id;
tasks count those pre-tokens by a set look-up and merge only the rest.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

_PATTERN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
_CACHE_LIMIT = 200_000


def _tokenizer(definition: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_str(definition)


def _byte_alphabet() -> dict[str, int]:
    """Printable stand-ins of the byte-level alphabet: printable Latin-1 stands for itself, the other bytes count up from U+0100."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}


def supported(definition: dict) -> bool:
    """Whether the shortcut's assumptions hold: plain byte-level BPE without normaliser, and added tokens without flags."""
    pre, model = definition.get("pre_tokenizer") or {}, definition.get("model") or {}
    return (
        definition.get("normalizer") is None
        and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True)
        and model.get("type") == "BPE" and not model.get("dropout") and not model.get("ignore_merges")
        and not any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in definition.get("added_tokens") or [])
    )


def prove_whole(definition: str) -> frozenset[str]:
    """Vocabulary strings that are one pre-token and encode alone as their own single id."""
    fields = json.loads(definition)
    if not supported(fields):
        return frozenset()
    special = {t["content"] for t in fields.get("added_tokens") or []}
    alphabet, strings, ids = _byte_alphabet(), [], []
    for piece, token in fields["model"]["vocab"].items():
        if piece in special or not all(c in alphabet for c in piece):
            continue
        try:
            strings.append(bytes(alphabet[c] for c in piece).decode())
        except UnicodeDecodeError:
            continue  # part of a character: never a whole pre-token
        ids.append(token)
    tokenizer = _tokenizer(definition)
    proven = set()
    for string, token, code in zip(strings, ids, tokenizer.encode_batch(strings, add_special_tokens=False)):
        if code.ids == [token] and len(tokenizer.pre_tokenizer.pre_tokenize_str(string)) == 1:
            proven.add(string)
    return frozenset(proven)


class TokenCounter:
    """Counts the tokens of whole texts; one per Python worker."""

    def __init__(self, definition: str, whole: frozenset[str]):
        self.tokenizer = _tokenizer(definition)
        fields = json.loads(definition)
        self.shortcut = supported(fields)
        added = sorted((t["content"] for t in fields.get("added_tokens") or []), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, added))) if added else None
        self.whole, self.merged = whole, {}
        self.plain, self.odd = set(), set()

    def _pieces(self, text: str) -> list[str]:
        """Pre-tokens. Unicode versions of the two regex engines differ, so each new character is first tried in both."""
        seen = set(text)
        for c in seen - self.plain - self.odd:
            probe = f"a{c}1{c}!{c}\n"
            same = [x for _, x in self.tokenizer.pre_tokenizer.pre_tokenize_str(probe)] == [m.span() for m in _PATTERN.finditer(probe)]
            (self.plain if same else self.odd).add(c)
        if seen & self.odd:
            return [text[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]
        return _PATTERN.findall(text)

    def _merge(self, rest: list[str]) -> int:
        new = [p for p in dict.fromkeys(rest) if p not in self.merged]
        if len(self.merged) + len(new) > _CACHE_LIMIT:
            self.merged, new = {}, list(dict.fromkeys(rest))
        if new:
            self.merged.update(zip(new, map(len, self.tokenizer.encode_batch_fast(new, add_special_tokens=False))))
        return sum(map(self.merged.__getitem__, rest))

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if not self.shortcut:
            return len(self.tokenizer.encode(text, add_special_tokens=False))
        parts = self.special.split(text) if self.special else [text]
        n, whole = len(parts) - 1, self.whole
        for part in filter(None, parts):
            pieces = self._pieces(part)
            rest = [p for p in pieces if p not in whole]
            n += len(pieces) - len(rest) + (self._merge(rest) if rest else 0)
        return n


def token_counts(df: DataFrame, path: str, text: str = "text", column: str = "n_tokens") -> DataFrame:
    """``df`` with one more column: the tokens of the whole text under the tokenizer file ``path``.

    Null and empty texts have 0 tokens; special strings inside a text count as the
    library's default does (one token). Repeated rows and all other columns stay as
    they are; a column that already has the new name is replaced. No shuffle: each
    task streams its rows. The definition and the proven strings (bounded by the
    vocabulary file) are broadcast, so executors need no file of their own. A
    definition outside the shortcut's assumptions is encoded by the library as a whole.
    """
    definition = open(path, encoding="utf-8").read()
    shipped = df.sparkSession.sparkContext.broadcast((definition, prove_whole(definition)))
    base = df.drop(column)
    schema = base.select("*", F.lit(0).cast("long").alias(column)).schema

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = TokenCounter(*shipped.value)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text))
            counts = pa.array([counter.count(t.as_py()) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, counts], names=[*batch.schema.names, column])

    return base.mapInArrow(count, schema)
