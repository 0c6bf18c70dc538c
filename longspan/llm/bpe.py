"""Byte-pair encoding and decoding in batched numpy merge rounds.

The symbols of many words lie in one flat array. In each round every word merges its lowest-ranked pair, wherever it stands in
the word; ranks are found by binary search over the sorted pair keys. The vocabulary file's own size bounds what is broadcast.
Supported are vocabularies of the kind "byte-level alphabet with word ends": normal form C, white space as one space, lower
case, words split off by pattern, no decoder.

Null and empty texts have no tokens and decode to the empty text. Rows are encoded one by one, so repeated rows give repeated
results, and other columns are kept whatever their names. Texts of any length are encoded whole.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from longspan.llm.words import map_batches, map_blocks, ragged

#: UTF-8 bytes of text encoded together.
BLOCK_BYTES = 2 << 20
#: Different words kept encoded in a task; beyond it the task starts a new cache, which changes no result.
CACHE_WORDS = 150_000

_SPACE = "\t-\r " + "".join(map(chr, (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
_SPLIT = re.compile(f"[^{_SPACE}]+")
_ODD_SPACE = re.compile("[\x1c-\x1f]")
_NONE = np.iinfo(np.int32).max


@dataclass
class Vocabulary:
    """Tables of a vocabulary file: first symbols of bytes (inside a word and at its end), merges and token texts."""

    inner: np.ndarray
    last: np.ndarray
    pair_keys: np.ndarray
    pair_rank: np.ndarray
    merged: np.ndarray
    tokens: np.ndarray
    numbers: np.ndarray
    specials: dict[str, int]
    pattern: str
    size: int = field(default=0)


def byte_alphabet() -> list[str]:
    """The printable stand-in of each byte: itself where it prints in Latin-1, else the next character from U+0100 on."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(b if b in prints else next(others)) for b in range(256)]


def load(path: str) -> Vocabulary:
    """Read a vocabulary file on the driver."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, end = spec["model"], spec["model"]["end_of_word_suffix"]
    ids = model["vocab"]
    signs = byte_alphabet()
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    size = max([*ids.values(), *special.values()]) + 1
    tokens = np.full(size, "", dtype=object)
    for t, i in [*ids.items(), *special.items()]:
        tokens[i] = t
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    keys = np.array([ids[a] * size + ids[b] for a, b in merges], np.int64)
    order = np.argsort(keys)
    split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
    return Vocabulary(
        inner=np.array([ids[c] for c in signs], np.int64), last=np.array([ids[c + end] for c in signs], np.int64),
        pair_keys=keys[order], pair_rank=order.astype(np.int32), merged=np.array([ids[a + b] for a, b in merges], np.int64),
        tokens=tokens, numbers=np.array([str(i) for i in range(size)], dtype=object), specials=special,
        pattern=split["pattern"]["Regex"], size=size)


def _ranks(v: Vocabulary, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    key = left * v.size + right
    at = np.minimum(np.searchsorted(v.pair_keys, key), len(v.pair_keys) - 1)
    return np.where(v.pair_keys[at] == key, v.pair_rank[at], _NONE).astype(np.int32)


def merge_words(v: Vocabulary, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of all words on end, and their counts."""
    encoded = [w.encode() for w in words]
    size = np.fromiter(map(len, encoded), np.int64, len(encoded))
    flat = np.frombuffer(b"".join(encoded), np.uint8)
    symbol = v.inner[flat]
    final = np.cumsum(size) - 1
    symbol[final] = v.last[flat[final]]
    word = np.repeat(np.arange(len(words), dtype=np.int32), size)
    done_symbol, done_word = [], []

    rank = np.full(len(symbol), _NONE, np.int32)
    if len(symbol) > 1:
        rank[:-1] = _ranks(v, symbol[:-1], symbol[1:])
        rank[:-1][word[:-1] != word[1:]] = _NONE
    while len(symbol):
        first = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
        count = np.diff(np.append(first, len(word)))
        best = np.minimum.reduceat(rank, first)
        open_ = best != _NONE
        if not open_.all():
            keep = np.repeat(open_, count)
            done_symbol.append(symbol[~keep])
            done_word.append(word[~keep])
            symbol, word, rank, best, count = symbol[keep], word[keep], rank[keep], best[open_], count[open_]
            if not len(symbol):
                break
        at = np.flatnonzero(rank == np.repeat(best, count))
        run = np.concatenate(([True], np.diff(at) != 1))
        offset = np.arange(len(at)) - np.flatnonzero(run)[np.cumsum(run) - 1]
        at = at[offset % 2 == 0]
        symbol[at] = v.merged[rank[at]]
        stays = np.ones(len(symbol), bool)
        stays[at + 1] = False
        now = np.cumsum(stays) - 1
        symbol, word, rank = symbol[stays], word[stays], rank[stays]
        changed = np.unique(np.concatenate((now[at], np.maximum(now[at] - 1, 0))))
        nxt = np.minimum(changed + 1, len(symbol) - 1)
        fresh = _ranks(v, symbol[changed], symbol[nxt])
        fresh[(nxt == changed) | (word[changed] != word[nxt])] = _NONE
        rank[changed] = fresh
    if not done_symbol:
        return np.zeros(0, np.int32), np.zeros(len(words), np.int64)
    symbol, word = np.concatenate(done_symbol), np.concatenate(done_word)
    return symbol[np.argsort(word, kind="stable")].astype(np.int32), np.bincount(word, minlength=len(words))


class _Index(dict):
    """Numbers keys as they come."""

    def __missing__(self, key):
        self[key] = n = len(self)
        return n


class Encoder:
    """Encodes blocks of texts; keeps the words it has met, up to ``cache_words``."""

    def __init__(self, vocabulary: Vocabulary, cache_words: int = CACHE_WORDS):
        self.v, self.cache_words = vocabulary, cache_words
        self.pattern = regex.compile(vocabulary.pattern)
        self.special = re.compile("|".join(map(re.escape, vocabulary.specials))) if vocabulary.specials else None
        self._clear()

    def _clear(self) -> None:
        self.index, self.flat, self.ends = _Index(), np.zeros(0, np.int32), np.zeros(1, np.int64)

    def _chunks(self, text: str) -> list:
        """Runs without white space, normalised, and special tokens as (name,)."""
        if self.special is not None and "<" in text and (found := [*self.special.finditer(text)]):
            out, at = [], 0
            for m in found:
                out += [*self._plain(text[at:m.start()]), (m[0],)]
                at = m.end()
            return out + self._plain(text[at:])
        return self._plain(text)

    @staticmethod
    def _plain(text: str) -> list[str]:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        text = text.lower()
        return _SPLIT.findall(text) if _ODD_SPACE.search(text) else text.split()

    def _learn(self, chunks: list) -> None:
        """Encode chunks that are new and add them to the cache."""
        words, parts, of = _Index(), [], []
        for c in chunks:
            found = [c] if isinstance(c, tuple) or c.isalpha() else self.pattern.findall(c)
            parts += [words[w] for w in found]
            of.append(len(found))
        plain = [w for w in words if not isinstance(w, tuple)]
        place = {w: i for i, w in enumerate(plain)}
        ids, size = merge_words(self.v, plain)
        named = [w[0] for w in words if isinstance(w, tuple)]
        ids = np.concatenate((ids, np.array([self.v.specials[n] for n in named], np.int32)))
        size = np.concatenate((size, np.ones(len(named), np.int64)))
        first = np.cumsum(size) - size
        extra = iter(range(len(plain), len(plain) + len(named)))
        where = np.array([next(extra) if isinstance(w, tuple) else place[w] for w in words], np.int64)
        part = where[np.array(parts, np.int64)] if parts else np.zeros(0, np.int64)
        tokens = ids[ragged(first[part], size[part])]
        chunk_size = np.bincount(np.repeat(np.arange(len(chunks)), of), weights=size[part], minlength=len(chunks)).astype(np.int64)
        self.flat = np.concatenate((self.flat, tokens))
        self.ends = np.concatenate((self.ends, self.ends[-1] + np.cumsum(chunk_size)))

    def __call__(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all texts on end, and the offsets of the texts."""
        if len(self.index) > self.cache_words:
            self._clear()
        known = len(self.index)
        number = self.index.__getitem__
        places, counts = [], []
        for t in texts:
            row = list(map(number, self._chunks(t or "")))
            places.append(np.array(row, np.int64))
            counts.append(len(row))
        if len(self.index) > known:
            self._learn([*self.index][known:])
        at = np.concatenate(places) if places else np.zeros(0, np.int64)
        size = np.diff(self.ends)[at]
        ids = self.flat[ragged(self.ends[at], size)]
        upto = np.concatenate(([0], np.cumsum(size)))
        return ids, upto[np.concatenate(([0], np.cumsum(counts))).astype(np.int64)]


def decode_ids(v: Vocabulary, ids: np.ndarray) -> str:
    """The token texts with a space between; without a decoder word ends stay visible."""
    return " ".join(v.tokens[ids].tolist())


def encode(docs: DataFrame, path: str, *, text: str = "text", out: str = "token_ids") -> DataFrame:
    """The documents with their token ids as ``array<int>``; an existing column of that name is replaced."""
    sent = docs.sparkSession.sparkContext.broadcast(load(path))
    docs = docs.drop(out)
    schema = T.StructType([*docs.schema.fields, T.StructField(out, T.ArrayType(T.IntegerType(), False))])
    state: dict = {}

    def one(block):
        encoder = state.get("encoder") or state.setdefault("encoder", Encoder(sent.value))
        ids, offsets = encoder(block.column(text).to_pylist())
        tokens = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))
        return pa.RecordBatch.from_arrays([*block.columns, tokens], names=[*block.schema.names, out])

    return map_blocks(docs, text, one, schema, BLOCK_BYTES)


def decode(tokens: DataFrame, path: str, *, ids: str = "token_ids", out: str = "decoded") -> DataFrame:
    """The rows with the text of their token ids; null ids decode to null."""
    sent = tokens.sparkSession.sparkContext.broadcast(load(path))
    tokens = tokens.drop(out)
    schema = T.StructType([*tokens.schema.fields, T.StructField(out, T.StringType())])

    def run(batches):
        for batch in batches:
            texts = [None if x is None else decode_ids(sent.value, np.array(x, np.int64)) for x in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, out])

    return map_batches(tokens, run, schema)


def digest(docs: DataFrame, path: str) -> DataFrame:
    """The contract's columns: ids of each whole text, and the text that these ids decode to."""
    sent = docs.sparkSession.sparkContext.broadcast(load(path))
    state: dict = {}

    def one(block):
        v = sent.value
        encoder = state.get("encoder") or state.setdefault("encoder", Encoder(v))
        ids, offsets = encoder(block.column("text").to_pylist())
        hashed, decoded = [], []
        for a, b in zip(offsets[:-1], offsets[1:], strict=True):
            own = ids[a:b]
            hashed.append(hashlib.sha256(" ".join(v.numbers[own].tolist()).encode()).hexdigest())
            decoded.append(hashlib.sha256(decode_ids(v, own).encode()).hexdigest())
        return pa.RecordBatch.from_arrays(
            [block.column("doc_id"), pa.array(np.diff(offsets), pa.int64()), pa.array(hashed, pa.string()), pa.array(decoded, pa.string())],
            names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return map_blocks(docs.select("doc_id", F.col("text").cast("string").alias("text")), "text", one,
                      "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string", BLOCK_BYTES)
