"""Toxicity scores of text restored by noisy-channel decoding.

1. Character model: counts of character 4-grams over every document, summed by Spark into a table of
   fixed size (32 character classes to the fourth power).
2. Restoring: a token that shows leetspeak, spelled-out spacing or repetition opens a lattice: each
   character may stand for itself, for the letters it imitates, or for nothing (separators and
   repeated letters). Viterbi search finds the likeliest letters under channel costs and the
   character model, over the whole token, whatever its length. Accented and full-width letters are read
   as plain ones too. A token without such signs has one path only and is its own restoration.
3. Scoring: a decision list of words and word beginnings, learned from labelled restored texts by
   sequential covering; a text scores the highest shrunk precision among its tokens.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter, defaultdict
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carestay.llm.store import map_arrow, strings, utf8

#: Labelled rows that the word list is learned from, at most (taken by hash order of doc_id).
FIT_ROWS = 4_000
#: Word beginnings of these lengths are features, next to whole words.
STEMS = (4, 5, 6, 7)
#: Distinct tokens whose scores one Python worker remembers.
CACHE_TOKENS = 300_000

# What a character may imitate.
IMITATES = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s",
            "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i", "а": "a", "е": "e", "о": "o", "с": "c", "р": "p",
            "х": "x", "і": "i", "ѕ": "s"}
MASKS = {"*": "aeiou"}  # between two letters
SEPARATORS = "-_.*~'`^,/\\|+:;#=​­"

# Channel costs in nats.
COST_IMITATED, COST_MASKED, COST_SEPARATOR, COST_REPEATED, COST_SYMBOL = 1.5, 2.0, 0.7, 0.7, 6.0

BOUNDARY, OTHER_LETTER, DIGIT, SYMBOL = 0, 27, 28, 29
CLASSES = 32


def _byte_classes() -> np.ndarray:
    """Character class of each UTF-8 byte: white space, a to z, other letters, digits, symbols."""
    out = np.full(256, SYMBOL, np.int64)
    out[[9, 10, 11, 12, 13, 32]] = BOUNDARY
    for i in range(26):
        out[97 + i] = out[65 + i] = i + 1
    out[48:58] = DIGIT
    out[128:] = OTHER_LETTER
    return out


BYTE_CLASS = _byte_classes()


def char_ngram_counts(docs: DataFrame) -> DataFrame:
    """(gram, n): counts of class 4-grams over the whole text of every row, a table of at most 32**4 rows."""

    def run(batch: pa.RecordBatch):
        total = np.zeros(CLASSES ** 4, np.int64)
        held, size = [], 0
        for text in [*utf8(batch.column(0)), None]:
            if text is not None:
                held += [b"   ", text]
                size += len(text)
            if held and (text is None or size > 1 << 20):
                c = BYTE_CLASS[np.frombuffer(b"".join(held) + b" ", np.uint8)]
                total += np.bincount(((c[:-3] * CLASSES + c[1:-2]) * CLASSES + c[2:-1]) * CLASSES + c[3:], minlength=CLASSES ** 4)
                held, size = [], 0
        at = np.flatnonzero(total)
        return pa.array(at), pa.array(total[at])

    return map_arrow(docs.select("text"), run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


class CharModel:
    """-log P(class | three classes before), interpolated over shorter contexts."""

    def __init__(self, counts: np.ndarray):
        c4 = counts.reshape((CLASSES,) * 4).astype(np.float64)
        p = np.full(CLASSES, 1 / CLASSES)
        for order in (1, 2, 3, 4):
            c = c4.sum(axis=tuple(range(4 - order))) if order < 4 else c4
            p = (c + 4.0 * p) / (c.sum(axis=-1, keepdims=True) + 4.0)
        self.cost = (-np.log(p)).astype(np.float32).reshape(-1, CLASSES)

    @staticmethod
    def fit(docs: DataFrame) -> "CharModel":
        counts = np.zeros(CLASSES ** 4, np.int64)
        for gram, n in char_ngram_counts(docs).toLocalIterator():
            counts[gram] = n
        return CharModel(counts)


def char_class(ch: str) -> int:
    if "a" <= ch <= "z":
        return ord(ch) - 96
    return BOUNDARY if ch == " " else DIGIT if ch.isdigit() else OTHER_LETTER if ch.isalpha() else SYMBOL


def lattice(token: str) -> list[list[tuple[str, float]]]:
    """For each character the strings it may stand for, with channel costs."""
    out = []
    for i, ch in enumerate(token):
        options = []
        if ch.isalpha() and ch not in IMITATES:
            options.append((ch, 0.0))
            if i and token[i - 1] == ch:
                options.append(("", COST_REPEATED))
        elif ch == " ":
            options += [(" ", 0.0), ("", COST_SEPARATOR)]
        else:
            options.append((ch, COST_SYMBOL if not ch.isalpha() else 0.0))
            options += [(x, COST_IMITATED) for x in IMITATES.get(ch, "")]
            if ch in MASKS and token[i - 1:i].isalpha() and token[i + 1:i + 2].isalpha():
                options += [(x, COST_MASKED) for x in MASKS[ch]]
            if ch in SEPARATORS or i and token[i - 1] == ch:
                options.append(("", COST_SEPARATOR))
        out.append(options)
    return out


def restore(token: str, model: CharModel) -> str:
    """The likeliest letters behind one suspicious token (lower case), by Viterbi search over three-class contexts.

    A token of any length is decoded whole: a state holds a back pointer, not what it has made, so work is linear.
    """
    cost = model.cost
    paths: dict[int, tuple[float, tuple | None]] = {0: (0.0, None)}
    for options in [*lattice(token), [(" ", 0.0)]]:
        after: dict[int, tuple[float, tuple | None]] = {}
        for context, (so_far, made) in paths.items():
            row = cost[context]
            for ch, channel in options:
                if ch:
                    c = char_class(ch)
                    total, to, back = so_far + channel + row[c], (context * CLASSES + c) % CLASSES ** 3, (ch, made)
                else:
                    total, to, back = so_far + channel, context, made
                old = after.get(to)
                if old is None or total < old[0]:
                    after[to] = (total, back)
        paths = after
    _, back = min(paths.values(), key=lambda path: path[0])
    letters = []
    while back is not None:
        letters.append(back[0])
        back = back[1]
    return "".join(reversed(letters)).strip()


def folded(token: str) -> str:
    """A token with full-width and other compatible forms made plain and without accents."""
    if token.isascii():
        return token
    return "".join(ch for ch in unicodedata.normalize("NFKD", token) if not unicodedata.combining(ch))


EDGE = " \t.,;:?!\"'()[]{}<>|&%#*~`«»¿¡…-_=/\\"
#: What makes a word of letters suspicious: repetition, or letters of another script.
_SIGNS = re.compile(r"(.)\1|[" + "".join(c for c in IMITATES if c.isalpha()) + "]")
_SEPARATOR = re.compile("[" + re.escape("".join(c for c in SEPARATORS if c not in IMITATES)) + "]+")
_LONG_RUN = re.compile(r"(.)\1{3,}")
_DOUBLE = re.compile(r"(.)\1+")
_LOOKALIKE = re.compile("[" + "".join(c for c in IMITATES if c.isalpha()) + "]")
_EDGE_RUN = re.compile(r"([^\w\s])\1+$")


def core(token: str) -> str:
    """A lower-case token without the punctuation around it."""
    return _EDGE_RUN.sub("", token).strip(EDGE)


def is_suspicious(word: str) -> bool:
    """Whether a word's lattice has more than one path worth searching."""
    if word.isalpha():
        return _SIGNS.search(word) is not None
    return len(word) >= 3 and any(ch.isalpha() for ch in word)


def restored_words(token: str, model: CharModel) -> list[str]:
    """The words that stand behind one white-space-delimited token (or a spelled-out run of them)."""
    # a letter repeated beyond three times says nothing that three do not
    token = _LONG_RUN.sub(r"\1\1\1", token.lower())
    plain = folded(token)
    return _readings(token, model) if plain == token else _readings(token, model) + _readings(plain, model)


def _readings(token: str, model: CharModel) -> list[str]:
    if " " in token:
        return restore(token, model).split()
    # an edge mark may imitate a letter, so the bare token is searched as well
    words = [core(token)]
    doubled = token.endswith(("$$", "@@")) and token[-3:] != token[-1] * 3
    if (doubled or token[:1] in IMITATES) and len(token) >= 3 and token.strip(".,;:?\"'()[]{}") != words[0]:
        words.append(token.rstrip(".,;:?\"')]}"))
    out = []
    for word in words:
        if is_suspicious(word):
            # the likeliest reading, then of each part, and of single letters in a row, if the separators part words, then the plain parts
            parts = [p for p in _SEPARATOR.split(word) if p]
            if len(parts) > 1:
                rows = ["".join(p) for lone, p in groupby(parts, lambda p: len(p) == 1) if lone]
                out += [x for p in [*parts, *rows] if is_suspicious(p) for x in restore(p, model).split()]
                out += [x for x in rows if len(x) > 2]
            out += restore(word, model).split()
            out += [x for x in re.split(r"[\W\d_]+", word) if x]
        elif word:
            out.append(word)
    return out


def features(word: str) -> list[str]:
    """A word itself, marked as whole, without its double letters, and its beginnings."""
    return [word + "$", _DOUBLE.sub(r"\1", word) + "~", *[word[:k] for k in STEMS if len(word) >= k]]


#: Sign that a spelled-out run may be there: three tokens of at most one letter or digit each.
_MAYBE_SPELLED = re.compile(r"(?<!\S)(?:[^\w\s]|_)*+[^\W_]?+(?:[^\w\s]|_)*+(?:\s++(?:[^\w\s]|_)*+[^\W_]?+(?:[^\w\s]|_)*+){2}(?!\S)")


def lone_character(token: str) -> str:
    """The one letter, digit or imitating character of a token, without punctuation around it; else nothing."""
    for ch in (token, token.strip(EDGE), token.strip(".,;:?\"'[]{}")):
        if len(ch) == 1 and (ch.isalnum() or ch == "_" or ch in IMITATES):
            return ch
    return ""


def spelled_runs(text: str) -> list[str]:
    """Runs of three or more single characters that white space sets apart, with single spaces and no punctuation around them."""
    if _MAYBE_SPELLED.search(text) is None:
        return []
    out, run = [], []
    for token in [*text.split(), ""]:
        ch = lone_character(token)
        if ch:
            run.append(ch)
        else:
            if len(run) > 2:
                out.append(" ".join(run))
            run = []
    return out


def tokens_of(text: str) -> set[str]:
    """The distinct tokens of a text: white-space-delimited ones and spelled-out runs."""
    out = set(text.split())
    out.update(spelled_runs(text))
    return out


def learn(texts: list[tuple[str, int]], read, min_support: int = 3, min_precision: float = 0.9) -> dict[str, float]:
    """A decision list {feature: shrunk precision}; ``read`` gives the restored words of a token.

    A feature's support counts the toxic texts that hold it, but no more than its distinct left
    neighbours: words that merely accompany a toxic one in copies of one text have one witness, not
    many. Features enter by sequential covering of the toxic texts, and beyond that if their support
    is out of reach of chance among all features seen.
    """
    holders, witnesses, forms, clean = defaultdict(set), defaultdict(set), defaultdict(set), Counter()

    def note(word, at, witness):
        for f in features(word):
            holders[f].add(at)
            witnesses[f].add(witness)
            forms[f].add(word)

    toxic = [t for t, y in texts if y]
    for at, text in enumerate(toxic):
        before = ""
        for token in text.split():
            for word in read(token):
                note(word, at, before)
            before = token
        for run in spelled_runs(text):
            for word in read(run):
                note(word, at, (at, run))
    # a word beginning must have shown several words, else the whole word says it all
    seen_features = len(holders)
    live = {f: h for f, h in holders.items() if min(len(h), len(witnesses[f])) >= min_support
            and (f[-1] in "$~" or len(forms[f]) >= 3)}
    witnesses = {f: len(witnesses[f]) for f in live}
    del holders, forms
    known: dict[str, tuple] = {}  # most tokens share the empty tuple
    for text, y in texts:
        if not y:
            found = set()
            for token in tokens_of(text):
                own = known.get(token)
                if own is None:
                    own = known[token] = tuple({f for word in read(token) for f in features(word) if f in live})
                found.update(own)
            clean.update(found)

    def precision(n, f):
        return n / (n + clean[f])

    live = {f: h for f, h in live.items() if precision(len(h), f) >= min_precision}
    base = (len(toxic) + 1) / (len(texts) + 2)
    chance = math.log(100.0 * max(1, seen_features)) / -math.log(base)
    support = {f: min(len(h), witnesses[f]) for f, h in live.items()}
    chosen = {f for f in live if support[f] >= chance and not clean[f]}
    rest = {f: set(h) for f, h in live.items()}
    covered = set().union(*[rest[f] for f in chosen])
    while True:
        rest = {f: left for f, h in rest.items() if f not in chosen and min(len(left := h - covered), support[f]) >= min_support}
        if not rest:
            break
        best = max(rest, key=lambda f: (min(len(rest[f]), support[f]) * precision(len(rest[f]), f) ** 20, len(f)))
        chosen.add(best)
        covered = rest[best]
    # a beginning gives way to a longer one that nearly all its texts share: that says the same, and less of other words
    longer = defaultdict(list)
    for g in live:
        if g[-1] not in "$~":
            longer[g[:-1]].append(g)
    for k in STEMS[:-1]:
        for f in [f for f in chosen if len(f) == k and f[-1] not in "$~"]:
            same = [g for g in longer[f] if len(live[g]) >= 0.95 * len(live[f])]
            if same:
                chosen.remove(f)
                chosen.update(same)
    return {f: (support[f] + base) / (support[f] + clean[f] + 1.0) for f in chosen}


class ToxicityModel:
    """Character model and decision list; scores texts."""

    def __init__(self, chars: CharModel, weights: dict[str, float], base: float):
        self.chars, self.weights, self.base = chars, weights, base
        self.begins = {_DOUBLE.sub(r"\1", f.rstrip("$~"))[:4] for f in weights}
        self.cache: dict[str, float] = {}

    def token_score(self, token: str) -> float:
        if len(self.cache) >= CACHE_TOKENS:
            self.cache.clear()
        get, base = self.weights.get, self.base
        plain = token.rstrip(".,").lower()
        if plain.isalpha() and not _LOOKALIKE.search(plain):
            # its readings differ in repeated letters and accents only: without those, a feature must begin as it does
            bare = {_DOUBLE.sub(r"\1", x) for x in (plain, folded(plain))}
            if not any(x[:k] in self.begins for x in bare for k in range(1, 5)) and not _LOOKALIKE.search(folded(plain)):
                self.cache[token] = base
                return base
        s = self.cache[token] = max((get(f, base) for w in restored_words(token, self.chars) for f in features(w)), default=base)
        return s

    def score(self, text: str) -> float:
        get, make = self.cache.get, self.token_score
        best, more = self.base, 0.0
        for t in tokens_of(text):
            s = get(t)
            if s is None:
                s = make(t)
            if s > self.base:
                more += s
                if s > best:
                    best = s
        # further evidence breaks ties but never crosses 1
        return best + (1.0 - best) * 0.5 * (1.0 - 1.0 / (1.0 + more)) if best > self.base else best


def is_held_out(doc_id, folds: int, held: int) -> F.Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds)) == held


def labelled_sample(docs: DataFrame, labels: DataFrame, column: str, train: F.Column, limit: int) -> list[tuple[str, int]]:
    """At most ``limit`` labelled training texts, by hash order of doc_id; the bound keeps the sample fit for the driver."""
    ids = labels.where(F.col("doc_id").isNotNull() & F.col(column).isNotNull() & train).groupBy("doc_id").agg(
        F.max(column).cast("int").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).join(
        F.broadcast(ids), "doc_id").select("text", "y")
    return [(r["text"], r["y"]) for r in rows.toLocalIterator()]


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> ToxicityModel:
    """Fit on all texts (character model) and on labelled rows whose crc32(doc_id as text) mod 3 is not 1 (decision list)."""
    chars = CharModel.fit(docs)
    sample = [(t, int(y == 1)) for t, y in labelled_sample(docs, labels, "toxic", ~is_held_out(F.col("doc_id"), 3, 1), fit_rows)]
    return fit_words(chars, sample)


def fit_words(chars: CharModel, sample: list[tuple[str, int]]) -> ToxicityModel:
    weights = learn(sample, lambda token: set(restored_words(token, chars)))
    model = ToxicityModel(chars, weights, 0.0)
    missed = sum(1 for t, y in sample if y and model.score(t) == 0.0)
    model.base = min(0.5, (missed + 0.5) / (len(sample) + 10.0))
    model.cache.clear()
    return model


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """(doc_id, score) of each row's whole text, 0 to 1. Null and empty texts score the base rate of unexplained toxicity.

    Each row has its score, repeated rows and rows without doc_id included; an empty table gives an empty result. Columns
    other than ``doc_id`` and ``text`` are ignored, whatever their names.
    """
    model.cache.clear()
    shared = docs.sparkSession.sparkContext.broadcast(model)  # the table of classes and a bounded word list

    def run(batch: pa.RecordBatch):
        m = shared.value
        return batch.column(0), [m.score(t) for t in strings(batch.column(1))]

    return map_arrow(docs.select(F.col("doc_id").cast("long"), F.col("text")), run, "doc_id long, score double")


def without_toxic(docs: DataFrame, model: ToxicityModel, threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs`` (all columns, unchanged) that score under ``threshold``, in one pass without a shuffle.

    Rows are judged by their text alone: repeated rows go or stay together, rows without doc_id or text are scored like any.
    """
    model.cache.clear()
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def each(batches):
        for batch in batches:
            m = shared.value
            yield batch.filter(pa.array([m.score(t) < threshold for t in strings(batch.column(at))], pa.bool_()))

    return docs.mapInArrow(each, docs.schema)
