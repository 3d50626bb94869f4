"""Toxicity by a learned lexicon, met with spelling errors, and by the context of each hit.

The lexicon of words and stems comes from labelled rows: terms many times as frequent among toxic documents. Its trie is
intersected with Levenshtein automata: a state is the set of trie nodes reachable with their least number of errors, and the
sets are determinised when first met, so a word costs one look-up per character and most words leave the automaton early.
Hits are told apart by what stands around them: inside quotation marks or after words of reporting they count as quoted, next to a
form of address as directed. A logistic model weighs the kinds of hits.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beaconry.llm.common import prepare
from beaconry.llm.logistic import bounded, fit, logit, matrix

TRAIN_ROWS = 4000  # of each label
STEM = (4, 7)  # lengths of stems
SURE = 1e-9  # the same for terms that are met with spelling errors as well: the neighbours of a doubtful term say nothing
CHANCE = 2e-4  # probability of so many toxic documents among a term's, were it no sign
TIMES = 30.0  # how many times as frequent a term has to be among toxic documents
AROUND = 8  # words on either side of a hit
MOST_WORDS = 100_000
MOST_ENTRIES = 200_000  # of all remembered sets together: short words leave sets of many nodes
STRIP = "".join(map(chr, range(33, 48))) + "".join(map(chr, range(58, 65))) + "[\\]^_`{|}~“”„«»‘’…–—¡¿"
QUOTES = frozenset('"“”„«»')
# words of reporting and forms of address, in the four languages of the tables
REPORTING = frozenset("said says wrote called calls quoted quote word term dit écrit appelle mot sagte schrieb nannte wort dijo escribió llamó palabra".split())
ADDRESS = frozenset("you your you're u tu toi vous ton votre du dich dein ihr euch tú usted ustedes vosotros".split())


def folded(word: str) -> str:
    return word.strip(STRIP).lower()


class Lexicon:
    """Words and stems (ending in ``*``) in a trie, met by words with errors: one from four letters, two from nine, one inside a stem.

    An error is a letter too many, missing or wrong, or two neighbours swapped, at any place. A state is a set of trie nodes with their
    least errors; a node may wait for the other letter of a swap. Sets are determinised when first met.
    """

    def __init__(self, terms: list[str], sure: frozenset[str] | None = None):
        """``sure`` are the terms that may be misspelled, all by default; the others are met as they are."""
        self._children: list[dict[str, int]] = [{}]
        self._words: list[int | None] = [None]  # errors allowed to the word that ends here
        self._stems: list[int | None] = [None]
        self._length, self._budget = [0], [0]
        for term in sorted(terms):
            text, stem = term.rstrip("*"), term.endswith("*")
            allowed = 0 if len(text) < 4 or (sure is not None and term not in sure) else 1 if len(text) < 9 or stem else 2
            node = 0
            self._budget[0] = max(self._budget[0], allowed)
            for at, char in enumerate(text):
                if char not in self._children[node]:
                    self._children[node][char] = len(self._children)
                    self._children.append({})
                    self._words.append(None)
                    self._stems.append(None)
                    self._length.append(at + 1)
                    self._budget.append(0)
                node = self._children[node][char]
                self._budget[node] = max(self._budget[node], allowed)
            (self._stems if stem else self._words)[node] = allowed
        self._reset()

    def _reset(self) -> None:
        start = self._close({(0, ""): 0})
        self._sets, self._numbers, self._steps, self._stem, self._held = [start], {}, [{}], [None], len(start)

    def _close(self, found: dict[tuple[int, str], int]) -> tuple[tuple[tuple[int, str], int], ...]:
        queue = list(found.items())
        while queue:  # letters left out of the word
            (node, waits), errors = queue.pop()
            for child in () if waits else self._children[node].values():
                if errors + 1 <= self._budget[child] and errors + 1 < found.get((child, ""), 9):
                    found[child, ""] = errors + 1
                    queue.append(((child, ""), errors + 1))
        return tuple(sorted(found.items()))

    def _build(self, state: int, char: str) -> int:
        found: dict[tuple[int, str], int] = {}

        def reach(node: int, errors: int, waits: str = "") -> None:
            if errors <= self._budget[node] and errors < found.get((node, waits), 9):
                found[node, waits] = errors

        for (node, waits), errors in self._sets[state]:
            if waits:
                if char == waits:
                    reach(node, errors)
                continue
            for letter, child in self._children[node].items():
                reach(child, errors + (letter != char))
                if letter != char and char in self._children[child]:
                    reach(self._children[child][char], errors + 1, letter)  # the two are swapped
            reach(node, errors + 1)
        # a stem is met when its last letter is read; leaving that out would make a shorter stem
        stem = min((e for (n, waits), e in found.items() if not waits and self._stems[n] is not None and e <= self._stems[n]), default=None)
        key = self._close(found)
        number = (key, stem)
        target = self._numbers.get(number)
        if target is None:
            target = self._numbers[number] = len(self._sets)
            self._sets.append(key)
            self._steps.append({})
            self._stem.append(stem)
            self._held += len(key) + 4
        self._steps[state][char] = target
        self._held += 1
        return target

    def match(self, word: str) -> tuple[int, bool] | None:
        """Least number of errors to a term, and whether that says little (errors in a stem or a word of four letters); None if none is near enough."""
        if self._held > MOST_ENTRIES:
            self._reset()
        state, stem = 0, None
        for char in word:
            step = self._steps[state].get(char)
            state = step if step is not None else self._build(state, char)
            if self._stem[state] is not None:
                if self._stem[state] == 0:
                    return 0, False
                stem = self._stem[state]
            if not self._sets[state]:
                break
        else:
            ends = [(e, e > 0 and self._length[n] < 5) for (n, waits), e in self._sets[state] if not waits and self._words[n] is not None and e <= self._words[n]]
            if ends:
                best = min(ends)
                return best if stem is None else min(best, (stem, True))
        return None if stem is None else (stem, True)

    def errors(self, word: str) -> int | None:
        """Least number of errors to a term, None if none is near enough."""
        met = self.match(word)
        return met and met[0]


class Words(dict):
    """Kind of each raw word: 0 nothing, 1 a term, 2 a term with errors, 3 one with errors that says little."""

    def __init__(self, lexicon: Lexicon):
        self.lexicon = lexicon

    def __missing__(self, word: str) -> int:
        met = self.lexicon.match(folded(word))
        kind = 0 if met is None else 1 if met[0] == 0 else 3 if met[1] else 2
        if len(word) < 64:
            if len(self) >= MOST_WORDS:
                self.clear()
            self[word] = kind
        return kind


def hits(text: str, words: Words) -> list[tuple[int, bool, bool]]:
    """For each hit its kind, whether it is quoted and whether it is directed at someone."""
    raw = text.split()
    kinds = list(map(words.__getitem__, raw))
    if not any(kinds):
        return []
    out = []
    for at, kind in enumerate(kinds):
        if kind:
            before, after = raw[max(0, at - AROUND):at], raw[at + 1:at + 1 + AROUND]
            marks = sum(c in QUOTES for w in before for c in w) + sum(c in QUOTES for c in raw[at][:1])
            closing = any(c in QUOTES for w in [raw[at][1:], *after] for c in w)
            near = {folded(w) for w in before}
            out.append((kind, (marks % 2 == 1 and closing) or bool(near & REPORTING), bool((near | {folded(w) for w in after}) & ADDRESS)))
    return out


FEATURES = 6


def features(text: str, words: Words) -> list[float]:
    """Logarithms of the numbers of terms, of terms with errors, of quoted and of directed hits, and of hits per thousand words; then of hits that say little.

    The last are counted apart: how much they weigh is learned, and they are neither quoted nor directed.
    """
    found = hits(text, words)
    sure = [h for h in found if h[0] != 3]
    plain = [h for h in sure if not h[1]]
    return [np.log1p(sum(k == 1 for k, _, _ in plain)), np.log1p(sum(k == 2 for k, _, _ in plain)),
            np.log1p(len(sure) - len(plain)), np.log1p(sum(d for _, _, d in plain)),
            np.log1p(1000 * len(plain) / (len(text) / 6 + 50)), np.log1p(1000 * (len(found) - len(sure)) / (len(text) / 6 + 50))]


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: dict[str, list[int]] = {}
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
            own = {folded(w) for w in (text or "").split()}
            own |= {w[:k] + "*" for w in own for k in range(STEM[0], min(STEM[1], len(w)) + 1)}
            for term in own:
                counts.setdefault(term, [0, 0])[toxic] += 1
        counts.pop("", None)
        rows = [(t, a, b) for t, (a, b) in counts.items()]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64()),
                                          pa.array([r[2] for r in rows], pa.int64())], names=["term", "clean", "toxic"])


def by_chance(hits: int, trials: int, share: float) -> float:
    """Probability of at least ``hits`` in so many trials of this probability."""
    if share >= 1:
        return 1.0
    return sum(math.comb(trials, k) * share ** k * (1 - share) ** (trials - k) for k in range(hits, trials + 1))


def learn_terms(train: DataFrame) -> tuple[list[str], frozenset[str]]:
    """Terms from a bounded sample (text, toxic): ``TIMES`` as frequent among toxic texts as among clean ones, and in more of them than chance explains; and those
    of them that are sure enough to be met with errors."""
    totals = Counter({r["toxic"]: r["c"] for r in train.groupBy("toxic").agg(F.count("*").alias("c")).collect()})
    if not totals[1]:
        return [], frozenset()
    counts = train.mapInArrow(_terms, "term string, clean long, toxic long").groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    kept = counts.where(F.col("toxic") / totals[1] >= TIMES * (F.col("clean") + 0.5) / (totals[0] + 0.5)).collect()  # terms of a bounded sample
    share = totals[1] / (totals[0] + totals[1])
    chance = {r["term"]: by_chance(r["toxic"], r["clean"] + r["toxic"], share) for r in kept}
    support = {r["term"]: r["toxic"] for r in kept if chance[r["term"]] < CHANCE}
    out: list[str] = []
    for term in sorted(support, key=lambda t: (len(t.rstrip("*")), t)):
        text = term.rstrip("*")
        if any(text.startswith(s[:-1]) for s in out if s.endswith("*")):
            continue
        longer = [n for t, n in support.items() if t != term and t.rstrip("*").startswith(text) and (len(t.rstrip("*")) > len(text) or not t.endswith("*"))]
        if term.endswith("*") and max(longer, default=0) >= 0.97 * support[term]:
            continue  # the longer term says as much
        out.append(term)
    return out, frozenset(t for t in out if chance[t] < SURE)


def toxicity(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """Per row doc_id, held_out, score (0 to 1), predicted, n_hits and n_quoted.

    Learns from at most about ``train_rows`` rows of each label whose crc32(doc_id as text) mod 5 is not 0; labels that are null
    or neither 0 nor 1 are not used, and of several labels of an id the greatest counts. Null texts are scored as empty ones; rows
    without id are scored and not held out; texts are read whole, however long; repeated rows are scored one by one; other columns are ignored. Without any labels the score is 0.5.
    """
    spark = prepare(docs.sparkSession)
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("held_out", held)
    marks = labels.where(F.col("toxic").isin(0, 1)).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    marks = bounded(marks.withColumn("held_out", held).where("NOT held_out"), "doc_id", "toxic", train_rows).select("doc_id", "toxic", "weight")  # about 2 * train_rows rows
    # copies of one text count once; the label's weight goes with the label
    train = (texts.join(F.broadcast(marks), "doc_id").groupBy(F.sha2("text", 256)).agg(F.max("text").alias("text"), F.max(F.struct("toxic", "weight")).alias("label"))
             .select("text", "label.toxic", "label.weight"))
    terms, sure = learn_terms(train)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(Lexicon(terms, sure))
        for batch in batches:
            rows = [features(t or "", words) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.float64())), batch.column("toxic"), batch.column("weight")], names=["x", "toxic", "weight"])

    sample = train.mapInArrow(measure, "x array<double>, toxic int, weight double").collect()  # a bounded sample
    model = fit(matrix([r["x"] for r in sample]), np.array([r["toxic"] for r in sample], dtype=float), counts=np.array([r["weight"] for r in sample]))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(Lexicon(terms, sure))
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            x = np.array([features(t, words) for t in texts]).reshape(len(texts), FEATURES)
            p = 1 / (1 + np.exp(-logit(x, model))) if len(model[1]) else np.full(len(texts), 0.5)
            counts = np.rint(np.expm1(x)).astype(np.int64) if len(texts) else np.zeros((0, FEATURES), dtype=np.int64)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("held_out"), pa.array(p), pa.array((p >= 0.5).astype(np.int32)),
                pa.array(counts[:, 0] + counts[:, 1]), pa.array(counts[:, 2])],
                names=["doc_id", "held_out", "score", "predicted", "n_hits", "n_quoted"])

    return texts.select("doc_id", "held_out", "text").mapInArrow(
        score, "doc_id long, held_out boolean, score double, predicted int, n_hits long, n_quoted long")
