"""Toxicity (9): a weighted finite-state pattern grammar over clauses.

A lexical transducer turns the words of a clause into classes: insult, threat,
target, negation, report, other.  Four small weighted transducers run over the
classes - insults near a target weigh more, a threat needs its intent or a
target, negation and reported speech lower what follows - and are composed
(their product machine is built state by state as it is met).  A matched clause
scores the weight that the composition emits; a document's score is a logistic
function of its clause weights.

Insults are a small general list plus words and word stems learned from a
bounded sample of labelled texts: stems are taken greedily while each still
explains toxic texts that no earlier one does and hardly occurs in clean ones.

Defined cases: a null or empty text has no clause and gets the base score;
without toxic labels the general list and default coefficients serve; texts
are scanned whole; other columns are ignored or carried.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkrec.llm.common import annotate, least_of_each

SAMPLE = 1500  # labelled documents of each label that the lexicon and the coefficients are learned from
MAX_CHARS = 20_000  # longer texts are not eligible for the sample
STEM = range(4, 9)  # characters of a learned stem
SUPPORT = 3  # toxic texts that a learned pattern must newly explain
CLEAN_SHARE = 0.02  # of clean texts relative to toxic ones that a learned pattern may touch

# General word classes.
INSULTS = ("idiot idiots moron morons stupid loser losers clown clowns scum trash pathetic worthless disgusting "
           "imbecile dumb fool fools jerk filthy vermin connard salaud imbécile débile dummkopf trottel abschaum "
           "widerlich estúpido basura asqueroso imbécil").split()
THREATS = "kill hurt destroy beat burn crush murder stab shoot tuer frapper töten vernichten matar golpear".split()
INTENT = "will gonna shall vais werde voy".split()
TARGETS = ("you your yours he him his she her they them their ihr dich dir euch sie tu vous toi leur usted "
           "ustedes ellos").split()
NEGATIONS = "not never nobody isn't aren't don't nicht kein keine niemals jamais aucun nunca tampoco".split()
REPORTS = "said says wrote claimed called quoted sagte schrieb disait écrit dijo escribió".split()

CLAUSE_END = ".!?;\n"
WORD = re.compile(r"[^\W_]+(?:'[^\W_]+)?")


class Transducer:
    """States are integers from 0; ``arcs[state, word class]`` is (next state, factor), any other class ``rest``."""

    def __init__(self, arcs: dict, rest: dict | None = None):
        self.arcs, self.rest = arcs, rest or {}

    def step(self, state: int, kind: str) -> tuple[int, float]:
        return self.arcs.get((state, kind)) or self.rest.get(state) or (0, 1.0)


def near(kind: str, factor: float, reach: int, on: tuple[str, ...]) -> Transducer:
    """``factor`` for classes ``on`` within ``reach`` words after a word of class ``kind``."""
    arcs, rest = {}, {}
    for s in range(reach + 1):
        arcs[s, kind] = (reach, 1.0)
        rest[s] = (max(0, s - 1), 1.0)
        for o in on:
            arcs[s, o] = (max(0, s - 1), factor if s else 1.0)
    return Transducer(arcs, rest)


INSULT = Transducer({(0, "insult"): (0, 1.0)})
TARGET = near("target", 1.25, 4, ("insult", "threat"))
NEGATION = near("negation", 0.5, 3, ("insult", "threat"))
#: An intent or target before the threat verb arms it (state 2), else it counts little.
THREAT = Transducer({(0, "intent"): (1, 1.0), (0, "target"): (1, 1.0), (1, "intent"): (1, 1.0), (1, "target"): (1, 1.0),
                     (0, "threat"): (0, 0.2), (1, "threat"): (1, 1.0)}, {1: (1, 1.0)})
#: A report holds to the end of its clause.
REPORT = Transducer({(0, "report"): (1, 1.0), (1, "insult"): (1, 0.6), (1, "threat"): (1, 0.6)}, {1: (1, 1.0)})


class Composition:
    """The transducers run together; a word's weight is multiplied by every factor.  States are made as needed."""

    def __init__(self, *parts: Transducer):
        self.parts = parts
        self.start = (0,) * len(parts)
        self.table: dict = {}

    def step(self, state: tuple, kind: str) -> tuple[tuple, float]:
        if (state, kind) not in self.table:
            out = [p.step(s, kind) for p, s in zip(self.parts, state)]
            self.table[state, kind] = tuple(s for s, _ in out), float(np.prod([f for _, f in out]))
        return self.table[state, kind]

    def weight(self, clause: list[tuple[str, float]]) -> float:
        state, total = self.start, 0.0
        for kind, weight in clause:
            state, factor = self.step(state, kind)
            total += weight * factor
        return total


@dataclass
class Grammar:
    insults: dict[str, float] = field(default_factory=lambda: dict.fromkeys(INSULTS, 1.0))
    stems: dict[str, float] = field(default_factory=dict)
    #: constant, log of the clause weight, log of the clause weight per 1,000 characters
    coefficients: tuple[float, float, float] = (-3.0, 3.0, 1.0)

    def __post_init__(self) -> None:
        self.machine = Composition(INSULT, TARGET, NEGATION, THREAT, REPORT)
        self.kinds = {w: k for k, words in (("report", REPORTS), ("negation", NEGATIONS), ("target", TARGETS),
                                            ("intent", INTENT)) for w in words}
        whole = "|".join(map(re.escape, [*self.insults, *THREATS]))
        stems = "|".join(map(re.escape, self.stems))
        self.found = re.compile(rf"\b(?:(?:{whole})\b" + (rf"|(?:{stems})" if stems else "") + ")")
        self.ends = re.compile(f"[{re.escape(CLAUSE_END)}]")

    def word(self, w: str) -> tuple[str, float]:
        """The lexical transducer: class and weight of a word."""
        if w in self.insults:
            return "insult", self.insults[w]
        for n in STEM:
            if w[:n] in self.stems:
                return "insult", self.stems[w[:n]]
        if w in THREATS:
            return "threat", 1.0
        return self.kinds.get(w, "other"), 0.0

    def clauses(self, text: str) -> list[float]:
        """Weights of the clauses that hold an insult or threat word."""
        text = text.lower()
        out, done = [], -1
        for m in self.found.finditer(text):
            if m.start() < done:
                continue
            first = max(text.rfind(c, done if done > 0 else 0, m.start()) for c in CLAUSE_END) + 1
            end = self.ends.search(text, m.end())
            done = end.start() if end else len(text)
            out.append(self.machine.weight([self.word(w) for w in WORD.findall(text, max(first, 0), done)]))
        return out

    def features(self, text: str | None) -> tuple[float, float, float]:
        total = sum(self.clauses(text)) if text else 0.0
        return 1.0, float(np.log1p(total)), float(np.log1p(1000 * total / max(1, len(text or ""))))

    def scores(self, texts: list) -> np.ndarray:
        x = np.array([self.features(t) for t in texts]).reshape(-1, 3)
        return 1 / (1 + np.exp(-x @ np.array(self.coefficients)))


def patterns(text: str) -> set[tuple[str, bool]]:
    """Whole words of a text, and the stems that two or more of its words share."""
    words = {w for w in WORD.findall(text.lower()) if len(w) > 2}
    stems = Counter(w[:n] for w in words for n in STEM if len(w) >= n)
    return {(w, True) for w in words} | {(w, False) for w, n in stems.items() if n > 1}


def learn_lexicon(toxic: list[str], clean: list[str]) -> tuple[dict[str, float], dict[str, float]]:
    """(whole words, stems) with weights: greedy cover of the toxic texts under the clean share."""
    known = Grammar()
    support: Counter = Counter()
    for text in toxic:
        support.update(patterns(text))
    held: dict = {p: set() for p, n in support.items() if n >= SUPPORT}
    del support
    for i, text in enumerate(toxic):
        for p in patterns(text) & held.keys():
            held[p].add(i)
    touched: Counter = Counter()
    for text in clean:
        touched.update(patterns(text) & held.keys())
    ratio = (len(clean) + 1) / (len(toxic) + 1)
    held = {p: docs for p, docs in held.items() if touched[p] <= CLEAN_SHARE * ratio * len(docs)}
    open_docs = {i for i, text in enumerate(toxic) if not known.clauses(text)}
    words, stems = {}, {}
    while held and open_docs:
        # most newly explained texts; of equals the longest, so that a stem is not cut short
        best = max(held, key=lambda p: (len(held[p] & open_docs), len(held[p]), len(p[0]), p))
        new = held.pop(best) & open_docs
        if len(new) < SUPPORT:
            break
        open_docs -= new
        (words if best[1] else stems)[best[0]] = 1.0
    return words, stems


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, max_chars: int = MAX_CHARS) -> Grammar:
    """Learn lexicon and coefficients from ``docs`` (doc_id, text) that ``labels`` (doc_id, toxic 0/1) covers.

    The sample - at most ``sample`` texts of each label, by hash - is drawn
    among labelled texts of at most ``max_chars`` characters on ids and hashes
    alone, then broadcast, so texts are not shuffled.
    """
    known = labels.select("doc_id", "toxic").filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1)).distinct()
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("h")).filter(F.length("text") <= max_chars)
    marked = texts.select("doc_id", "h").join(known, "doc_id").distinct().withColumn("order", F.xxhash64("doc_id", "h"))
    picked = least_of_each(marked, "toxic", "order", sample).select("doc_id", "h", "toxic")
    rows = texts.join(F.broadcast(picked), ["doc_id", "h"]).groupBy("doc_id", "h", "toxic").agg(F.min("text").alias("text")).collect()
    return fit(sorted({(int(r["toxic"]), r["text"]) for r in rows}))


def fit(rows: list[tuple[int, str]]) -> Grammar:
    rows = sorted(rows)
    toxic = [t for y, t in rows if y == 1]
    clean = [t for y, t in rows if y == 0]
    if not toxic:
        return Grammar()
    words, stems = learn_lexicon(toxic, clean)
    grammar = Grammar({**Grammar().insults, **words}, stems)
    design = np.array([grammar.features(t) for _, t in rows])
    y = np.array([label for label, _ in rows], float)
    beta = np.zeros(3)
    ridge = np.diag([0.01, 0.05, 0.05])
    for _ in range(50):  # penalised Newton steps
        p = 1 / (1 + np.exp(-design @ beta))
        beta = beta + np.linalg.solve(design.T @ (design * (p * (1 - p))[:, None]) + ridge,
                                      design.T @ (y - p) - ridge @ beta)
    return Grammar(grammar.insults, grammar.stems, tuple(float(b) for b in beta))


def predict(docs: DataFrame, grammar: Grammar, keep: list[str]) -> DataFrame:
    """``row`` (columns ``keep``) and ``score`` for every document."""
    shared = docs.sparkSession.sparkContext.broadcast(grammar)

    def score(texts: list) -> list:
        g = shared.value
        return [pa.array(g.scores(texts))]

    return annotate(docs, keep, score, "score double")
