"""Byte-pair encoding and decoding from a public vocabulary file.

Each word is merged with a priority queue of merge ranks over a doubly linked symbol list; queue
entries whose symbols have changed since are skipped as stale. Decoding concatenates the
vocabulary strings, with the space that the file's absent decoder puts between tokens.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import struct
import unicodedata

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carestay.llm.store import map_arrow, strings

#: Distinct words whose merges one Python worker remembers.
CACHE_WORDS = 300_000


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte: printable Latin-1 characters stand for themselves, the others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, extra = [], 0
    for b in range(256):
        if b in plain:
            out.append(chr(b))
        else:
            out.append(chr(256 + extra))
            extra += 1
    return out


class WordBPE:
    """Encoder and decoder of one vocabulary file of the kind "BPE with word ends; lower case, white space dropped"."""

    def __init__(self, definition: str):
        spec = json.loads(definition)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.end: str = model["end_of_word_suffix"]
        self.strings = {i: t for t, i in self.vocab.items()}
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.merges[self.vocab[a], self.vocab[b]] = (rank, self.vocab[a + b])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings |= {i: t for t, i in self.special.items()}
        self.split_special = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.words = regex.compile(pattern).findall
        self.space = regex.compile(r"\s+")
        symbols = byte_symbols()
        self.first = [self.vocab[s] for s in symbols]
        self.last = [self.vocab[s + self.end] for s in symbols]
        self.cache: dict[str, tuple[bytes, str]] = {}

    def merge(self, word: bytes) -> list[int]:
        """Ids of one word."""
        n = len(word)
        ids = [self.first[b] for b in word[:-1]] + [self.last[word[-1]]]
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        merges = self.merges
        queue = [(*found, i, ids[i], ids[i + 1]) for i in range(n - 1) if (found := merges.get((ids[i], ids[i + 1])))]
        heapq.heapify(queue)
        gone = -1
        while queue:
            _, new, i, left, right = heapq.heappop(queue)
            j = after[i]
            if ids[i] != left or j < 0 or ids[j] != right:
                continue  # stale: one of the two symbols has been merged meanwhile
            ids[i], ids[j] = new, gone
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b >= 0 and (found := merges.get((ids[a], ids[b]))):
                    heapq.heappush(queue, (*found, a, ids[a], ids[b]))
        return [x for x in ids if x != gone]

    def word(self, word: str) -> tuple[bytes, str]:
        """A word's ids as little-endian 32-bit integers, and its decoded text."""
        ids = self.merge(word.encode())
        if len(self.cache) >= CACHE_WORDS:
            self.cache.clear()
        made = self.cache[word] = (struct.pack(f"<{len(ids)}I", *ids), self.decode(ids))
        return made

    def normal(self, text: str) -> str:
        if not text.isascii():
            # lower-casing goes character by character, so a word-final sigma is no exception
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return self.space.sub(" ", text).lower()

    def pieces(self, text: str) -> list[tuple[bytes, str]]:
        """(ids, decoded text) of each word and each special token of a whole text."""
        if self.split_special is None or "<|" not in text:
            parts = [text]
        else:
            parts, at = [], 0
            for m in self.split_special.finditer(text):
                parts += [text[at:m.start()], m[0]]
                at = m.end()
            parts.append(text[at:])
        out = []
        cache = self.cache
        for k, part in enumerate(parts):
            if k % 2:
                out.append((struct.pack("<I", self.special[part]), part))
            elif part:
                out.extend([cache.get(w) or self.word(w) for w in self.words(self.normal(part))])
        return out

    def encode(self, text: str) -> list[int]:
        raw = b"".join(ids for ids, _ in self.pieces(text))
        return list(struct.unpack(f"<{len(raw) // 4}I", raw))

    def decode(self, ids: list[int]) -> str:
        return " ".join([self.strings[i] for i in ids])


_LOADED: dict[str, WordBPE] = {}


def loaded(definition: str) -> WordBPE:
    """The encoder of a definition, made once in each Python worker, so that its word cache lasts over tasks."""
    key = hashlib.sha256(definition.encode()).hexdigest()
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = WordBPE(definition)
    return _LOADED[key]


def _definition(docs: DataFrame, vocabulary: str):
    with open(vocabulary, encoding="utf-8") as f:
        return docs.sparkSession.sparkContext.broadcast(f.read())  # a fixed file of a few MB


def encode(docs: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, ids, decoded): token ids of each row's whole text and the decoded text. Null text counts as empty: no ids."""
    shared = _definition(docs, vocabulary)

    def run(batch: pa.RecordBatch):
        bpe = loaded(shared.value)
        made = [bpe.pieces(t) for t in strings(batch.column(1))]
        ids = [list(struct.unpack(f"<{len(raw) // 4}I", raw)) for raw in (b"".join(x for x, _ in p) for p in made)]
        return batch.column(0), ids, [" ".join([x for _, x in p]) for p in made]

    return map_arrow(docs.select(F.col("doc_id").cast("long"), F.col("text")), run, "doc_id long, ids array<long>, decoded string")


def encode_digests(docs: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of each row; ids are hashed as little-endian unsigned 32-bit integers.

    Null and empty texts have no tokens. Repeated rows give repeated rows; other columns are ignored.
    """
    shared = _definition(docs, vocabulary)
    sha = hashlib.sha256

    def run(batch: pa.RecordBatch):
        bpe = loaded(shared.value)
        n, ids, decoded = [], [], []
        for text in strings(batch.column(1)):
            made = bpe.pieces(text)
            raw = b"".join([x for x, _ in made])
            n.append(len(raw) // 4)
            ids.append(sha(raw).hexdigest())
            decoded.append(sha(" ".join([x for _, x in made]).encode()).hexdigest())
        return batch.column(0), n, ids, decoded

    return map_arrow(docs.select(F.col("doc_id").cast("long"), F.col("text")), run,
                     "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
