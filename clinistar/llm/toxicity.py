"""Operator 9: toxicity by a weighted finite-state pattern grammar.

Words are read as classes: insult, threat, target, negation, report, or other.
Insults and threats are patterns (words, or stems marked by ``*``) learnt from
labelled rows; the function words of the other classes are fixed. Five small
transducers read the classes of a clause side by side: each keeps a state and
may answer. Their composition is one automaton, whose final state says what
kind of clause it is, so a clause is scored and not its words. The weighted
kinds of a document's clauses enter a logistic score.

Patterns and weights are learnt from at most ``SAMPLE`` labelled rows of each
label, taken by a hash of the id; rows held out are never among them. Scoring
covers every whole text and shuffles nothing.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinistar.llm.common import staged, table

#: Labelled rows of each label that are learnt from, at most.
SAMPLE = 4000
#: A pattern is in so many toxic rows, so many times likelier there than in
#: others, and this sure (log likelihood ratio), at least; candidates at most.
LEAST_ROWS, LIFT, SURE, CANDIDATES = 3, 20.0, 24.0, 5000
#: A row explained by so many words needs no further patterns.
EXPLAINED = 3
#: In a second pass, over rows that no word explains, this sure is enough.
SURE_OF_REST = 12.0
#: A stem may be in one other row for so many toxic ones.
STEM_ROWS = 200
#: Lengths of stems.
STEMS = range(3, 8)
THRESHOLD = 0.7
WORDS = re.compile(r"[^\W_]+")
CLAUSES = re.compile(r"[^.!?;:\n]+")
#: A negation reaches this many words ahead.
REACH = 3

#: Function words of the grammar in English, German, French, Spanish (fixed values).
TARGETS = frozenset(
    "you your yours he him his she her they them their we us "
    "du dich dir dein deine ihr euch euer er ihn ihm sie ihnen "
    "tu te toi ton ta tes vous votre vos il elle ils elles "
    "ti usted ustedes vosotros ellos ellas él ella".split()
)
NEGATIONS = frozenset("not no never nor without nicht kein keine nie niemals ohne ne pas jamais sans non nunca jamás sin ni".split())
REPORTS = frozenset(
    "said says wrote writes called quoted reported sagt sagte schrieb zitiert nannte dit écrit cité appelé dijo dice escribió llamó citó".split()
)
THREATS = frozenset("kill hurt destroy beat burn töten schlagen vernichten tuer frapper détruire matar golpear destruir".split())

#: The kinds of a clause, in the order of the features.
KINDS = ("insult", "insult at a target", "negated insult", "reported insult", "threat")


def classes(word: str, weights: dict[str, float]) -> tuple[str, float]:
    """The class of a word and, for an insult, its pattern's weight."""
    weight = max((weights.get(p, 0.0) for p in patterns(word)), default=0.0)
    if weight > 0:
        return "insult", weight
    for name, words in (("threat", THREATS), ("target", TARGETS), ("negation", NEGATIONS), ("report", REPORTS)):
        if word in words:
            return name, 0.0
    return "other", 0.0


def patterns(word: str) -> Iterator[str]:
    """The word, and its stems."""
    yield word
    for n in STEMS:
        if len(word) >= n:
            yield word[:n] + "*"


# The transducers: (state, class) -> state. What isn't listed keeps the state.
INSULT = {(0, "insult"): 1}
TARGET = {(0, "target"): 1}
REPORT = {(0, "report"): 1}  # reported is what follows a report
THREAT = {(0, "threat"): 1, (1, "target"): 2}
NEGATION = {(s, "negation"): REACH for s in range(REACH + 1)} | {(s, c): s - 1 for s in range(1, REACH + 1) for c in ("other", "target", "report", "threat", "insult")}


def compose() -> dict[tuple, tuple]:
    """The composition: its states are those of the five side by side, and
    whether an insult was met plainly, negated, or reported."""
    start = (0, 0, 0, 0, 0, frozenset())
    table: dict[tuple, tuple] = {}
    todo = [start]
    while todo:
        s = todo.pop()
        insult, target, report, threat, negation, met = s
        for c in ("insult", "threat", "target", "negation", "report", "other"):
            how = "reported" if report else "negated" if negation else "plain"
            after = (
                INSULT.get((insult, c), insult), TARGET.get((target, c), target), REPORT.get((report, c), report),
                THREAT.get((threat, c), threat), NEGATION.get((negation, c), negation),
                met | {how} if c == "insult" else met,
            )
            if (s, c) not in table:
                table[s, c] = after
                todo.append(after)
    return table


def kinds(state: tuple) -> Iterator[int]:
    """What a clause that ends in this state is, by position in ``KINDS``; an
    insult at a target is an insult too."""
    _, target, _, threat, _, met = state
    if "plain" in met:
        yield 0
        if target:
            yield 1
    elif "negated" in met:
        yield 2
    elif "reported" in met:
        yield 3
    if threat == 2:
        yield 4


START = (0, 0, 0, 0, 0, frozenset())
AUTOMATON = compose()


@dataclass
class Model:
    patterns: dict[str, float] = field(default_factory=dict)
    #: One weight per kind of clause, then the intercept.
    weights: list[float] = field(default_factory=lambda: [0.0] * len(KINDS) + [-4.0])
    known: dict[str, tuple[str, float]] = field(default_factory=dict)

    def read(self, word: str) -> tuple[str, float]:
        got = self.known.get(word)
        if got is None:
            if len(self.known) >= 50_000:
                self.known.clear()
            got = self.known[word] = classes(word, self.patterns)
        return got

    def features(self, text: str | None) -> list[float]:
        """For each kind, the weights of its clauses, on a log scale."""
        total = [0.0] * len(KINDS)
        lowered = (text or "").lower()
        if any(self.read(w)[0] in ("insult", "threat") for w in set(WORDS.findall(lowered))):
            for clause in CLAUSES.finditer(lowered):
                state, weight = START, 0.0
                for w in WORDS.finditer(clause.group()):
                    c, x = self.read(w.group())
                    state, weight = AUTOMATON[state, c], max(weight, x)
                for kind in kinds(state):
                    total[kind] += weight if kind < 4 else 1.0
        return [math.log1p(x) for x in total]

    def score(self, text: str | None) -> float:
        z = self.weights[-1] + sum(w * x for w, x in zip(self.weights, self.features(text)))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learnt from; a null id has no such row."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def learnable(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``text, toxic`` of the sampled labelled rows. The ids are bounded by
    twice ``sample``, so they go to the documents and no text is shuffled."""
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max(F.col("toxic") > 0).alias("toxic"))
    key = F.xxhash64(F.lit(9), "doc_id")
    some = [known.where(F.col("toxic") == t).orderBy(key, "doc_id").limit(sample) for t in (F.lit(True), F.lit(False))]
    ids = some[0].unionByName(some[1]).withColumnRenamed("doc_id", "label_id")
    return docs.select("doc_id", "text").join(F.broadcast(ids), F.col("doc_id") == F.col("label_id")).select("text", "toxic")


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Patterns and weights. Without toxic rows to learn from, nothing is toxic."""
    rows = staged(learnable(docs, labels, sample), "toxicity-sample")
    sizes = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    n_toxic, n_clean = sizes.get(True, 0), sizes.get(False, 0)
    if not n_toxic or not n_clean:
        return Model()

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        toxic, clean = Counter(), Counter()
        for b in batches:
            for text, t in zip(b["text"], b["toxic"]):
                found = {p for w in set(WORDS.findall((text or "").lower())) for p in patterns(w)}
                (toxic if t else clean).update(found)
        yield pd.DataFrame([(p, n, clean[p]) for p, n in toxic.items()], columns=["pattern", "toxic", "clean"])
        yield pd.DataFrame([(p, 0, n) for p, n in clean.items() if p not in toxic], columns=["pattern", "toxic", "clean"])

    counts = rows.mapInPandas(count, "pattern string, toxic long, clean long").groupBy("pattern").agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c"))
    lift = ((F.col("t") + 0.5) / (n_toxic + 1)) / ((F.col("c") + 0.5) / (n_clean + 1))
    best = counts.where(F.col("t") >= LEAST_ROWS).withColumn("lift", lift).where(F.col("lift") >= LIFT)
    candidates = {r["pattern"] for r in best.orderBy(F.desc(F.col("t") * F.log("lift")), "pattern").limit(CANDIDATES).collect()}

    def matching(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            words = [sorted(w for w in set(WORDS.findall((t or "").lower())) if not candidates.isdisjoint(patterns(w))) for t in b["text"]]
            yield pd.DataFrame({"words": words, "toxic": b["toxic"].to_numpy()})

    found = rows.mapInPandas(matching, "words array<string>, toxic boolean").where(F.size("words") > 0).orderBy("words", "toxic").collect()
    model = Model(choose([(set(r["words"]), r["toxic"]) for r in found], candidates, n_toxic, n_clean))

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"x": [model.features(t) for t in b["text"]], "toxic": b["toxic"].to_numpy()})

    learnt = rows.mapInPandas(features, "x array<double>, toxic boolean").orderBy("x", "toxic").collect()  # at most 2 * sample rows
    x = np.column_stack([np.array([r["x"] for r in learnt]), np.ones(len(learnt))])
    model.weights = logistic(x, np.array([r["toxic"] for r in learnt], dtype=np.float64)).tolist()
    model.known.clear()
    return model


def choose(rows: list[tuple[set[str], bool]], candidates: set[str], n_toxic: int, n_clean: int) -> dict[str, float]:
    """Patterns and their weights, chosen one after the other.

    The next pattern is the one that best tells the labels apart on words
    which no chosen pattern matches, in rows not yet explained. So neither the
    longer stems of a chosen one nor the chance words of its rows' copies get
    in. Of patterns nearly as good the most special one is taken.
    """
    where: dict[str, set[tuple[int, str]]] = {}
    for i, (words, _) in enumerate(rows):
        for w in words:
            for p in patterns(w):
                if p in candidates:
                    where.setdefault(p, set()).add((i, w))
    left, explained, chosen = [set(w) for w, _ in rows], [0] * len(rows), {}

    def value(p: str) -> tuple[float, float]:
        hit = {i for i, w in where[p] if w in left[i]}
        t = sum(rows[i][1] for i in hit)
        if p.endswith("*") and STEM_ROWS * (len(hit) - t) > t:
            return 0.0, 0.0
        return sureness(t, len(hit) - t, n_toxic, n_clean)

    for sure, enough in ((SURE, EXPLAINED), (SURE_OF_REST, 1)):
        for i, n in enumerate(explained):
            if n >= enough:
                left[i].clear()
        # A pattern's value hardly rises, so the best is found among stale values from the top.
        queue = sorted(((value(p), p) for p in where if p not in chosen), key=lambda x: (-x[0][0], x[1]))
        while queue and queue[0][0][0] >= sure:
            fresh = [(value(p), p) for _, p in queue[:64]]
            top = max(v[0] for v, _ in fresh)
            if len(queue) > 64 and top < queue[64][0][0]:
                queue = sorted(fresh + queue[64:], key=lambda x: (-x[0][0], x[1]))
                continue
            if top < sure:
                break
            near = [(v, p) for v, p in fresh if v[0] >= 0.97 * top]
            (_, lift), p = max(near, key=lambda x: (not x[1].endswith("*"), len(x[1]), x[0][0], x[1]))
            chosen[p] = lift
            for i, w in where[p]:
                if w in left[i]:
                    left[i].discard(w)
                    explained[i] += 1
                    if explained[i] >= enough:
                        left[i].clear()
            queue = sorted(((v, q) for v, q in fresh + queue[64:] if q != p), key=lambda x: (-x[0][0], x[1]))
    return chosen


def sureness(t: int, c: int, n_toxic: int, n_clean: int) -> tuple[float, float]:
    """Log likelihood ratio of a pattern in ``t`` toxic and ``c`` other rows, and
    its log lift; 0 if it isn't a sign of toxicity."""
    lift = ((t + 0.5) / (n_toxic + 1)) / ((c + 0.5) / (n_clean + 1))
    if t < LEAST_ROWS or lift < LIFT:
        return 0.0, 0.0
    all_of = n_toxic + n_clean
    ratio = t * math.log(t * all_of / ((t + c) * n_toxic)) + (c * math.log(c * all_of / ((t + c) * n_clean)) if c else 0.0)
    return 2 * ratio, math.log(lift)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05, steps: int = 50) -> np.ndarray:
    """Weights by Newton's method; both labels weigh the same in sum, and no
    kind of clause may speak for a document: weights of kinds are at least 0."""
    w = np.zeros(x.shape[1])
    share = np.where(y > 0, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum())) * len(y)
    penalty = np.r_[np.full(len(w) - 1, ridge), 1e-6]
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (share * (p - y)) + penalty * w
        free = (w > 0) | (gradient < 0) | (np.arange(len(w)) == len(w) - 1)
        hessian = (x * (share * p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.zeros(len(w))
        step[free] = np.linalg.solve(hessian[np.ix_(free, free)], gradient[free])
        w = w - step
        w[:-1] = np.maximum(w[:-1], 0.0)
    return w


def score_of(text: Column, model: Model) -> Column:
    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([model.score(t) for t in texts], dtype="float64")

    return score(text)


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs``.

    ``docs`` needs ``doc_id, text``, ``labels`` needs ``doc_id, toxic``; other
    columns are ignored. A null or empty text has no clause and gets the score
    of such texts; a null id is scored and isn't held out; repeated rows are
    scored each; an id with several labels is toxic if one says so. No rows
    give no rows.
    """
    model = learn(docs, labels)
    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score_of(F.col("text"), model).alias("score")).withColumn(
        "predicted", F.when(F.col("score") >= threshold, 1).otherwise(0)
    )


def clean_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that aren't toxic, whole."""
    return docs.where(score_of(F.col("text"), learn(docs, labels)) < threshold)


def op9_toxicity(spark, sf_dir) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
