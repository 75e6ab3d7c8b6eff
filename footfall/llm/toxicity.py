"""Toxicity: a lexicon matched with misspellings, and scores by context.

Lexicon. From a bounded sample of labelled documents (``SAMPLE`` rows, smallest
hashes of doc_id), word beginnings of 4 to 12 letters and whole words are
counted by class. One that stands in toxic documents and hardly in clean ones
is taken if chance does not explain it. By chance a unit of n documents is as
toxic as that with a beta-binomial probability; its mean is that of the units
of 2 and 3 documents, its spread the largest found among units of about n or
fewer documents (copies of a document raise it). Summed over all units this gives how many to expect. Units
are taken, the least likely first, up to where ``CHANCE`` of those found
exceeds those expected the most. So the number of documents a term needs
follows from the sample (two can do), and nothing else limits the terms.
The shortest such beginning becomes a term, lengthened while it keeps its
documents; a whole word that no beginning covers is matched exactly, whatever
its length.

Matching. The terms form a trie. A Levenshtein automaton of distance 1 runs
over trie and word at once: its states are sets of (trie node, edits spent),
made when first reached and kept, so a word is read once, character by
character, and is dropped as soon as no term is within reach. Terms of fewer
than ``FUZZY`` letters and whole words take no edits.

Context. A match is weighed by the words around it (``WINDOW`` on each side):
one that stands between an opening and a closing quotation mark, or right
after a word of speaking, is quoted and
is summed in a feature of its own, as are misspelled ones and those aimed at a
reader ("you"). A logistic model over the summed log odds of the matched terms, fitted on
the same bounded sample, gives the score. The prior weights say that a quoted match is weaker
evidence than a plain one; the sample moves them where it has such cases.

Rows: one result per input row; null and empty texts have no match and get
the model's score for none. Repeated rows repeat. Without any toxic label the
lexicon is empty and the prior decides (score below 0.5). Extra columns are
ignored; a score depends on the text alone.
"""

from __future__ import annotations

import bisect
import math
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import staged

SAMPLE = 20_000  # labelled documents that lexicon and model are fitted on
CHANCE = 2 / 3  # chance may explain this share of the last beginnings or words taken
LONGEST = 12
PURITY = 50.0  # toxic documents per clean one, after allowing for the classes' sizes
FUZZY = 5
WINDOW = 6
STATES = 1 << 16  # automaton states kept per worker
CACHE = 1 << 18  # words remembered per worker
WHOLE = "$"  # ends a term that is a whole word
WORD = re.compile(r"\w+")
#: Opening quotation marks and what closes each.
PAIRS = {'"': '"', "'": "'’", "“": "”", "„": "“”", "”": "”", "«": "»", "»": "«", "‘": "’", "‚": "‘’", "’": "’", "‹": "›", "›": "‹"}
MARK = re.compile("[" + "".join(PAIRS) + "]")
#: Words of speaking and of address, in the corpus's languages.
SPEAKING = frozenset("said says wrote writes quoted quote called calls term word sagte schrieb nannte zitat wort dijo escribió llamó palabra dit écrit appelé mot citation".split())
ADDRESS = frozenset("you your you're du dich dir ihr euch sie tu te toi vous usted ustedes eres".split())

#: Weights of the model before it sees the sample: intercept, plain, quoted, misspelled, aimed.
PRIOR = np.array([-4.0, 2.5, 0.5, 0.5, 0.3])


class Automaton:
    """Levenshtein automaton of distance 1, intersected with a trie of terms; a term may be followed by anything, unless it ends in ``WHOLE``."""

    def __init__(self, terms: dict[str, float], fuzzy: int = FUZZY):
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[float] = [0.0]  # the weight of the term that ends here
        self.soft: list[bool] = [False]  # a term of at least ``fuzzy`` letters lies below
        self.whole = {t[:-1]: w for t, w in terms.items() if t.endswith(WHOLE)}
        terms = {t: w for t, w in terms.items() if not t.endswith(WHOLE)}
        for term in sorted(terms):
            node = 0
            for c in term:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.ends.append(0.0)
                    self.soft.append(False)
                node = self.children[node][c]
            self.ends[node] = terms[term]
        self._mark(sorted(terms), fuzzy)
        self.start = self._state({(0, 0)})
        self._reset()
        self._words: dict[str, tuple[int, float]] = {}

    def _mark(self, terms: list[str], fuzzy: int) -> None:
        for term in terms:
            node = 0
            for c in term if len(term) >= fuzzy else "":
                node = self.children[node][c]
                self.soft[node] = True

    def _reset(self) -> None:
        self._moves: dict[frozenset, dict[str, frozenset]] = {}

    def _state(self, nodes: set[tuple[int, int]]) -> frozenset:
        """Add what deleting one letter of a term reaches."""
        more = {(child, 1) for node, spent in nodes if not spent for child in self.children[node].values() if self.soft[child]}
        nodes = nodes | more
        return frozenset((n, e) for n, e in nodes if not e or (n, 0) not in nodes)

    def _step(self, state: frozenset, c: str) -> frozenset:
        out = set()
        for node, spent in state:
            if c in self.children[node]:
                out.add((self.children[node][c], spent))
            if not spent:
                if node and self.soft[node]:
                    out.add((node, 1))  # an extra letter, after the first
                out |= {(child, 1) for child in self.children[node].values() if self.soft[child]}
        return self._state({(n, e) for n, e in out if not e or self.soft[n]})

    def distance(self, word: str) -> tuple[int, float]:
        """0: the word begins with a term, 1: with a term misspelled by one edit, 2: neither; and the term's weight."""
        got = self._words.get(word)
        if got is None:
            if len(self._words) >= CACHE:
                self._words.clear()
            got = self._words[word] = self._read(word)
        return got

    def _read(self, word: str) -> tuple[int, float]:
        if word in self.whole:
            return 0, self.whole[word]
        state, best = self.start, (2, 0.0)
        for c in word:
            moves = self._moves.get(state)
            if moves is None:
                if len(self._moves) >= STATES:
                    self._reset()
                moves = self._moves[state] = {}
            following = moves.get(c)
            if following is None:
                following = moves[c] = self._step(state, c)
            state = following
            for node, spent in state:
                if self.ends[node] and (spent, -self.ends[node]) < (best[0], -best[1]):
                    best = (spent, self.ends[node])
            if not best[0] or not state:
                break
        return best


def _marks(text: str) -> list[tuple[int, str, bool, bool]]:
    """``position, mark, can open, can close`` of the quotation marks; a mark between letters is an apostrophe."""
    out = []
    for m in MARK.finditer(text):
        k, c = m.start(), m[0]
        before, after = text[k - 1:k], text[k + 1:k + 2]
        inner = bool(WORD.match(before)) and bool(WORD.match(after))
        if inner and c in "'’‘":
            continue
        spaced = c in "«»‹›"  # French sets them off by blanks
        opens = not WORD.match(before) and (bool(after.strip()) or spaced and c in "«‹")
        closes = not WORD.match(after) and (bool(before.strip()) or spaced and c in "»›")
        out.append((k, c, opens, closes))
    return out


def _quoted(marks: list[tuple[int, str, bool, bool]], start: int, end: int, first: int, last: int) -> bool:
    """Whether a mark opened from ``first`` on is open at ``start`` and closed between ``end`` and ``last``."""
    open_: list[str] = []
    for k, c, opens, closes in marks[bisect.bisect_left(marks, (first,)):]:
        if k >= last:
            break
        fits = [i for i, o in enumerate(open_) if closes and c in PAIRS[o]]
        if k < start:
            if fits:
                del open_[fits[-1]:]
            elif opens:
                open_.append(c)
        elif k >= end:
            if fits:
                return True
            if opens:
                open_ = [o for o in open_ if o != c]  # a new quotation: the mark before it was none
    return False


def features(text: str, automaton: Automaton) -> tuple[float, float, float, float]:
    """Summed weights of the terms of plain, quoted, misspelled and aimed matches."""
    low = text.lower()
    plain = quoted = soft = aimed = 0.0
    distance = automaton.distance
    words = WORD.findall(low)
    if all(distance(w)[0] == 2 for w in set(words)):
        return 0.0, 0.0, 0.0, 0.0
    spans, marks = [m.span() for m in WORD.finditer(low)], None
    for k, word in enumerate(words):
        edits, weight = distance(word)
        if edits == 2:
            continue
        before, after = words[max(0, k - WINDOW):k], words[k + 1:k + 1 + WINDOW]
        if marks is None:
            marks = _marks(low)
        first, last = spans[max(0, k - WINDOW)][0] - 1, spans[min(len(words) - 1, k + WINDOW)][1] + 1
        if _quoted(marks, *spans[k], first, last) or not SPEAKING.isdisjoint(before[-1:]):
            quoted += weight
        elif edits:
            soft += weight
        else:
            plain += weight
        aimed += weight * (not ADDRESS.isdisjoint(before + after))
    return plain, quoted, soft, aimed


@dataclass
class Model:
    terms: dict[str, float]
    weights: np.ndarray = field(default_factory=lambda: PRIOR.copy())
    _automaton: Automaton | None = None

    @property
    def automaton(self) -> Automaton:
        if self._automaton is None:
            self._automaton = Automaton(self.terms)
        return self._automaton

    def __getstate__(self):
        return {"terms": self.terms, "weights": self.weights, "_automaton": None}

    def score(self, counts: np.ndarray) -> np.ndarray:
        x = np.column_stack([np.ones(len(counts)), np.log1p(counts)])
        return 1 / (1 + np.exp(-np.clip(x @ self.weights, -30, 30)))


def held_out(doc_id: Column) -> Column:
    """The documents whose labels nothing is learnt from; a null id is not among them and has no label."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def training_sample(labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``doc_id, toxic`` of at most ``sample`` labelled documents that are not held out."""
    usable = (labels.where("doc_id is not null and toxic is not null").where(~held_out(F.col("doc_id")))
              .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    return usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)


def _beginnings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: dict[str, list[int]] = {}
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            words = set(WORD.findall((text or "").lower()))
            words = {w for w in words if not w[0].isdigit()}
            for stem in {w[:k] for w in words for k in range(4, min(LONGEST, len(w)) + 1)} | {w + WHOLE for w in words}:
                counts.setdefault(stem, [0, 0])[1 if toxic else 0] += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.string()), pa.array([c[0] for c in counts.values()], pa.int64()),
             pa.array([c[1] for c in counts.values()], pa.int64())], names=["stem", "clean", "toxic"])


def _unexplained(cells: dict[tuple[int, int], int], clean: int, toxic: int) -> set[tuple[int, int]]:
    """The ``(clean, toxic)`` counts that chance does not explain, of ``cells``: how many units have each."""
    few = [(c + t, t, m) for (c, t), m in cells.items() if c + t in (2, 3)]
    mean = sum(m * t / n for n, t, m in few) / (sum(m for *_, m in few) or 1)
    mean = min(max(mean, toxic / max(clean + toxic, 1), 1e-6), 1 - 1e-6)
    scale = PURITY * max(toxic, 1) / max(clean, 1)
    most = max((c + t for c, t in cells), default=0)
    ways = np.array([math.lgamma(k + 1) for k in range(most + 1)])
    sizes: dict[int, int] = {}
    classes: dict[int, list[float]] = {}
    for (c, t), m in cells.items():
        n = c + t
        sizes[n] = sizes.get(n, 0) + m
        if n > 1:
            sums = classes.setdefault(n.bit_length(), [0, 0.0])
            sums[0] += m
            sums[1] += m * t * (t - 1) / (n * (n - 1))
    spread, tails = 0.0, {}
    for k in range(1, most.bit_length() + 1):
        total, both = classes.get(k, (0, 0.0))
        if total:  # drawn towards the class before where units are few
            spread = max(spread, (total * (both / total - mean**2) / (mean * (1 - mean)) + 50 * spread) / (total + 50))
        spread = min(max(spread, 1e-6), 0.99)
        a, b = mean * (1 - spread) / spread, (1 - mean) * (1 - spread) / spread
        last = min(most, 2**k - 1)
        ups, downs, all_ = (np.array([math.lgamma(i + x) - math.lgamma(x) for i in range(last + 1)]) for x in (a, b, a + b))
        for n in range(2 ** (k - 1), last + 1):
            if n not in sizes:
                continue
            least = max(1, math.ceil(scale * n / (1 + scale) - 1e-9))
            t = np.arange(least, n + 1)
            chances = np.exp(ways[n] - ways[t] - ways[n - t] + ups[t] + downs[n - t] - all_[n])
            tails[n] = least, chances, np.cumsum(chances[::-1])[::-1]
    rare = {(c, t): tails[c + t][2][t - tails[c + t][0]] for c, t in cells if t >= tails[c + t][0]}
    levels = np.array(sorted(set(rare.values())))
    expected, found = np.zeros(len(levels) + 1), np.zeros(len(levels) + 1)
    for n, (_, chances, tail) in tails.items():
        np.add.at(expected, np.searchsorted(levels, tail * (1 - 1e-12)), sizes[n] * chances)
    for cell, p in rare.items():
        found[np.searchsorted(levels, p)] += cells[cell]
    gain = np.concatenate([[0.0], np.cumsum(CHANCE * found - expected)[:-1]])  # of taking none, the first level, the first two ...
    cut = int(gain.argmax())
    return {cell for cell, p in rare.items() if cut and p <= levels[cut - 1]}


def _lexicon(stems: list, clean: int, toxic: int) -> dict[str, float]:
    """Shortest beginnings, each lengthened while it keeps its documents, and whole words beside them, with their log odds."""
    counts = {r.stem: (r.toxic, r.clean) for r in stems}
    longer: dict[str, list[str]] = {}
    for s in counts:
        longer.setdefault(s[:-1], []).append(s)
    out: set[str] = set()
    for stem in sorted(counts, key=lambda s: (s.endswith(WHOLE), len(s), s)):
        if any(stem[:k] in out for k in range(4, min(LONGEST, len(stem)) + 1)):
            continue
        while not stem.endswith(WHOLE):
            following = [s for s in longer.get(stem, ()) if not s.endswith(WHOLE) and counts[s][0] >= 0.95 * counts[stem][0]]
            if not following:
                break
            stem = following[0]
        out.add(stem)
    return {s: math.log((counts[s][0] + 0.5) / (toxic + 1)) - math.log((counts[s][1] + 0.5) / (clean + 1)) for s in sorted(out)}


def _logistic(sums: np.ndarray, toxic: np.ndarray, prior: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Newton's method, drawn towards ``prior``; a match never speaks for a text, so negative weights go to 0."""
    every, used = np.column_stack([np.ones(len(sums)), np.log1p(sums)]), np.ones(len(prior), dtype=bool)
    while True:
        x, w = every[:, used], prior[used].copy()
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (toxic - p) - ridge * (w - prior[used]))
            w = w + step
            if np.abs(step).max() < 1e-9:
                break
        out = np.zeros(len(prior))
        out[used] = w
        if (out[1:] >= 0).all():
            return out
        used &= np.concatenate([[True], out[1:] > 0])


def _count(model: Model) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(t or "", model.automaton) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)] + [pa.array([f[k] for f in found], pa.float64()) for k in range(4)],
                names=["key", "plain", "quoted", "misspelled", "aimed"])
    return run


_COUNTS = "key bigint, plain double, quoted double, misspelled double, aimed double"


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Lexicon and weights from a bounded sample of labelled documents that are not held out."""
    spark = docs.sparkSession
    chosen = [(r.doc_id, r.toxic) for r in training_sample(labels, sample).collect()]  # bounded by ``sample``
    known = spark.createDataFrame(chosen, "doc_id bigint, toxic int")
    texts = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").select("text", F.col("toxic").cast("bigint").alias("toxic"))
    bad = sum(t for _, t in chosen)
    counted = staged(texts.mapInArrow(_beginnings, "stem string, clean bigint, toxic bigint").groupBy("stem")
                     .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")))
    whole = F.endswith("stem", F.lit(WHOLE))
    cells: dict[bool, dict] = {False: {}, True: {}}
    for r in counted.groupBy(whole.alias("whole"), "clean", "toxic").count().collect():  # at most as many as pairs of counts
        cells[r.whole][r.clean, r.toxic] = r["count"]
    taken = [(w, c, t) for w, each in cells.items() for c, t in _unexplained(each, len(chosen) - bad, bad)]
    stems = (counted.withColumn("whole", whole)
             .join(F.broadcast(spark.createDataFrame(taken, "whole boolean, clean bigint, toxic bigint")), ["whole", "clean", "toxic"])
             .select("stem", "clean", "toxic").collect())
    model = Model(_lexicon(stems, len(chosen) - bad, bad))
    rows = texts.select("toxic", "text").mapInArrow(_count(model), _COUNTS).collect()  # bounded by ``sample``
    if rows:
        table = np.array([tuple(r) for r in rows], dtype=float)
        model.weights = _logistic(table[:, 1:], table[:, 0], PRIOR)
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score`` and the four sums for every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _count(model)(batches):
            counts = np.column_stack([batch.column(k).to_numpy() for k in range(1, 5)]).reshape(-1, 4)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(model.score(counts))], names=[*batch.schema.names, "score"])
    return (docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, _COUNTS + ", score double")
            .withColumnRenamed("key", "doc_id"))


def without_toxic(docs: DataFrame, model: Model, limit: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score below ``limit``, in one pass: no row is matched by its id."""
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = names.index("text")
        for batch in batches:
            sums = np.array([features(t or "", model.automaton) for t in batch.column(at).to_pylist()]).reshape(-1, 4)
            yield batch.filter(pa.array(model.score(sums) < limit))
    return docs.mapInArrow(run, docs.schema)
