"""Secret scan: fixed base patterns, and novelty of candidates measured by dictionary-primed zstandard.

A candidate is a long string with digits or of mixed-up cases, near a sensitive word; a signed token of parts
joined by dots is one candidate. Its novelty is what it adds to the
compressed size of the text around it, by a compressor primed with identifiers; a candidate that
hardly compresses there is reported.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carestay.llm.store import map_arrow, strings

KINDS = ("assign", "access", "hex", "novel")

_ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_LONG_HEX = re.compile(r"[0-9a-f]{16,}")

#: Lengths that a match must reach: the assigned value, the access key, the hexadecimal run.
MIN_VALUE, MIN_ACCESS, MIN_HEX = 12, 18, 16
#: A candidate's least length, how far before it a sensitive word may stand, and how much text around it counts.
MIN_CANDIDATE, NEAR, AROUND = 16, 48, 240
#: Added compressed bytes per character from which a candidate counts as incompressible.
NOVELTY = 0.55
#: A string without digits looks random up to this share of vowels and below this share of word-like parts.
VOWELS, WORDY = 0.28, 0.75
#: Identifiers of the corpus that prime the compressor, at most.
DICTIONARY_WORDS = 2_000

# Words of a sensitive context, and identifiers common in code.
_SENSITIVE = re.compile(r"(?i:pass|pwd|secret|token|key|auth|cred|bearer|private|signature|session|cookie|jwt|akia|salt|hash)", re.A)
CODE_WORDS = """abstract access account address api app args argument array async await base64 begin body boolean bool branch break bucket
buffer build byte bytes cache case catch char class client cloud code column commit config connect connection const content context
continue cookie count create cursor database date debug decode default define delete description dict digest double else encode endpoint
enum environment error event example except exception export extends false fetch field file final finally float format from function
get global header host html http https identifier implements import include index init input insert instance int integer interface
internal item json key lambda length level license limit list local localhost lock log login long main map master message method mode
module name namespace new node none null number object offset open option order output package param parameter parse password path
pattern payload port post prefix print private process property protected protocol public query random read record reference region
release remote replace repository request require response result return root row schema script search secret select self server
service session set setting size source sql start state static status stdin stdout storage stream string struct suffix super switch
system table target task template test text this thread throw time timeout title token true try type unsigned update upload url user
username utf8 uuid value var variable vector version void while with write yaml yield zone""".split()

# a signed token begins with the base64 of a JSON object and goes on in parts after dots
_SIGNED = r"eyJ[A-Za-z0-9_-]{5,}\.[A-Za-z0-9_-]{5,}(?:\.[A-Za-z0-9_-]+)*"
_CANDIDATE = re.compile(rf"(?<![A-Za-z0-9+/_=-])(?:{_SIGNED}|[A-Za-z0-9+/_=-]{{{MIN_CANDIDATE},}})")
_DIGIT = re.compile(r"[0-9]")
_WORD_PART = re.compile(r"[A-Z]?[a-z]{3,}")
_VOWEL = re.compile(r"[AEIOUaeiou]")
_IDENTIFIER = re.compile(r"[A-Za-z_][A-Za-z_]{3,31}")
_HEX_BYTES = bytes(120 if chr(i) in "0123456789abcdef" else 32 for i in range(256))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind number) of the base patterns, leftmost and non-overlapping for each kind."""
    out = []
    if "=" in text or ":" in text:
        out += [(m.start(), m.end(), 0) for m in _ASSIGN.finditer(text) if len(m[2]) >= MIN_VALUE]
    if "AKIA" in text:
        out += [(m.start(), m.end(), 1) for m in _ACCESS.finditer(text) if len(m[0]) >= MIN_ACCESS]
    # a run of hexadecimal digits shows in the bytes as a run of x
    if b"x" * MIN_HEX in text.encode().translate(_HEX_BYTES):
        out += [(m.start(), m.end(), 2) for m in _LONG_HEX.finditer(text)]
    return sorted(out)


def _random_looking(s: str) -> bool:
    """It has a digit, or both cases, few vowels and few parts like those of camelCase words."""
    if _DIGIT.search(s):
        return True
    if s.islower() or s.isupper():
        return False
    return len(_VOWEL.findall(s)) <= VOWELS * len(s) and sum(map(len, _WORD_PART.findall(s))) < WORDY * len(s)


def candidates(text: str) -> list[tuple[int, int]]:
    """Long random-looking strings with a sensitive word shortly before them (or at their own start)."""
    return [m.span() for m in _CANDIDATE.finditer(text)
            if _random_looking(m[0]) and _SENSITIVE.search(text, max(0, m.start() - NEAR), m.start() + 4)]


class Novelty:
    """Marginal compressed bytes of a string within its surroundings."""

    def __init__(self, identifiers: list[str]):
        # later bytes of a dictionary are the nearest, so the most frequent words come last
        content = " ".join([*CODE_WORDS, *reversed(identifiers)]).encode()
        primed = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        self.compress = zstandard.ZstdCompressor(level=6, dict_data=primed, write_content_size=False, write_checksum=False).compress

    def added(self, before: str, candidate: str, after: str) -> float:
        """Bytes that the candidate adds, per character."""
        without = len(self.compress((before + after).encode()))
        return (len(self.compress((before + candidate + after).encode())) - without) / len(candidate)


def novel_spans(text: str, taken: list[tuple[int, int, int]], novelty: Novelty) -> list[tuple[int, int, int]]:
    """Incompressible candidates that touch no base span."""
    out = []
    for a, b in candidates(text):
        if not any(s < b and a < e for s, e, _ in taken):
            if novelty.added(text[max(0, a - AROUND):a], text[a:b], text[b:b + AROUND]) >= NOVELTY:
                out.append((a, b, 3))
    return out


def corpus_identifiers(docs: DataFrame, words: int = DICTIONARY_WORDS) -> list[str]:
    """The most frequent identifiers around candidates, counted over all rows; ties by name."""

    def run(batch: pa.RecordBatch):
        counts: Counter = Counter()
        for text in strings(batch.column(0)):
            for a, b in candidates(text):
                counts.update(_IDENTIFIER.findall(text[max(0, a - AROUND):a]))
                counts.update(_IDENTIFIER.findall(text[b:b + AROUND]))
        return list(counts), list(counts.values())

    counted = map_arrow(docs.select("text"), run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return [r["word"] for r in counted.orderBy(F.desc("n"), "word").limit(words).collect()]


def scan(docs: DataFrame, dictionary_words: int = DICTIONARY_WORDS) -> DataFrame:
    """(doc_id, starts, ends, kinds, values) of all spans of each row's whole text, in code points, end exclusive.

    ``dictionary_words`` bounds the corpus identifiers that prime the compressor; they are counted over all rows.
    Null texts count as empty and have no spans. Repeated rows give repeated rows; other columns are ignored.
    """
    return _spans(docs, lambda text, spans: ([s for s, _, _ in spans], [e for _, e, _ in spans], [KINDS[k] for _, _, k in spans],
                                             [text[s:e] for s, e, _ in spans]),
                  "starts array<long>, ends array<long>, kinds array<string>, values array<string>", dictionary_words)


def digests(docs: DataFrame, dictionary_words: int = DICTIONARY_WORDS) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_novel) of each row: what ``scan`` finds, in figures."""

    def joined(spans):
        return ",".join([f"{KINDS[k]}:{s}:{e}" for s, e, k in spans])

    def row(text, spans):
        base = [x for x in spans if x[2] < 3]
        n = Counter(k for _, _, k in spans)
        return n[0], n[1], n[2], hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans), n[3]

    return _spans(docs, row, "n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_novel long", dictionary_words)


def _spans(docs: DataFrame, row, schema: str, dictionary_words: int) -> DataFrame:
    identifiers = corpus_identifiers(docs, dictionary_words)  # a bounded list

    def run(batch: pa.RecordBatch):
        novelty = Novelty(identifiers)
        out = []
        for text in strings(batch.column(1)):
            base = base_spans(text)
            out.append(row(text, sorted(base + novel_spans(text, base, novelty))))
        return [batch.column(0), *map(list, zip(*out))]

    return map_arrow(docs.select(F.col("doc_id").cast("long"), F.col("text")), run, f"doc_id long, {schema}")
