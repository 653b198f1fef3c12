"""Toxicity by weak supervision: voters, a generative label model, and a linear classifier.

Voters are lexicon entries and patterns; each fires on a text or abstains. The label model is
a mixture of two classes in which voters fire independently, fitted by expectation and
maximisation over the counts of all vote patterns. Voters that fire together more than their
classes explain are correlated, and their evidence is shared out. The posterior labels of a
bounded sample of texts train a logistic regression over word indicators, which scores every text.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.labelled import labelled_sample, thinned
from quern.session import materialize, ship_package

BITS = 18

#: Insults and slurs of a general lexicon, one voter each. Fixed values.
LEXICON = """
idiot moron stupid dumb loser pathetic worthless disgusting scum trash clown fool jerk
freak filth vermin garbage imbecile cretin bastard
idiota estúpido imbécil basura inútil asqueroso payaso
idiote stupide imbécile ordure minable dégoûtant
dummkopf blödmann abschaum widerlich wertlos erbärmlich versager
""".split()

#: Pattern voters: forms of address, threats and ways of writing. Fixed values.
PATTERNS = {
    "you_are_a": r"\byou(?:'re| are)(?: all)? (?:an? |such |so )?(?:total |complete )?(?:idiot|moron|loser|fool|joke|disgrace)",
    "shut_up": r"\b(?:shut up|get lost|drop dead|go to hell|screw you)\b",
    "threat": r"\b(?:i(?:'ll| will) (?:kill|hurt|find|destroy) you|you (?:will|should) (?:die|suffer))\b",
    "hate": r"\bi (?:really |truly )?(?:hate|despise|loathe) (?:you|them|these|those)\b",
    "what_a": r"\bwhat an? (?:idiot|moron|loser|clown|joke|disgrace)\b",
    "masked": r"\b[a-z]+(?:\*\*|##|@@|\$\$)[*#@$]*[a-z]+\b",
    "stretched": r"\b(?:s+t+u{2,}p+i+d+|l+o+s+e{2,}r+|d+u+m{2,}b+)\b",
}

#: A pattern is searched only in texts with one of these strings. Fixed values.
PATTERN_GATES = {
    "you_are_a": ("idiot", "moron", "loser", "fool", "joke", "disgrace"),
    "shut_up": ("shut up", "get lost", "drop dead", "go to hell", "screw you"),
    "threat": ("kill you", "hurt you", "find you", "destroy you", "you will", "you should"),
    "hate": ("hate ", "despise ", "loathe "),
    "what_a": ("what a",),
    "masked": ("**", "##", "@@", "$$"),
    "stretched": ("uup", "eer", "mmb"),
}

#: Lengths of word stems, and voters' shares of stems in a thousand words.
STEM_LENGTHS = range(3, 8)
DENSITIES = (2, 4, 8, 12, 15, 20, 30)

_EDGES = ".,;:!?\"'()[]{}<>#*$%&|-_ "


@dataclass(frozen=True)
class ToxicitySetup:
    """Bounds of the samples, number and purity of induced voters, and rounds of the fits."""

    sample_rows: int = 8000
    induced_voters: int = 64
    least_support: int = 8
    least_precision: float = 0.2
    same_voters: float = 0.85
    rounds: int = 12
    descent_rounds: int = 400
    lasso: float = 2e-4


def profile(text: str | None) -> Counter[str]:
    """Counts of the lower-case words of the whole text, without punctuation at their ends."""
    counts: Counter[str] = Counter()
    for raw, n in Counter((text or "").lower().split()).items():
        word = raw.strip(_EDGES)
        counts[word] = counts.get(word, 0) + n
    counts.pop("", None)
    return counts


def bucket(word: str) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass")) & ((1 << BITS) - 1)


def stems(word: str) -> list[str]:
    """The word itself, and its beginnings of three to seven characters, which end in ``*``."""
    return [word, *(f"{word[:k]}*" for k in STEM_LENGTHS if k < len(word))]


def induce_lexicon(sample: DataFrame, setup: ToxicitySetup) -> list[str]:
    """Words and word stems of the labelled sample that tell label 1, best first.

    Each counts once per text and class; Spark groups them, and those with enough support and
    precision are ranked by their log-odds ratio in standard errors. Of a stem and its continuations
    only the best is kept, so that few voters say the same.
    """
    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [
                (s, int(y))
                for t, y in zip(batch["text"], batch["label"], strict=True)
                for s in {s for w in profile(t) for s in stems(w)}
            ]
            yield pd.DataFrame(rows, columns=["stem", "label"]).astype({"stem": object, "label": "int64"})

    total = sample.agg(F.count("*").alias("n"), F.sum("label").alias("t")).first()
    if not total.n or not total.t or total.t == total.n:
        return []
    counts = (
        sample.mapInPandas(spread, "stem string, label long")
        .groupBy("stem")
        .agg(F.count("*").alias("n"), F.sum("label").alias("t"))
        .filter((F.col("t") >= setup.least_support) & (F.col("t") >= F.col("n") * setup.least_precision))
    )
    a, b = F.col("t") + 0.5, F.col("n") - F.col("t") + 0.5
    c, d = total.t - F.col("t") + 0.5, total.n - total.t - (F.col("n") - F.col("t")) + 0.5
    # Log-odds ratio in standard errors: a stem with many continuations beats each of them.
    z = F.log(a * d / (b * c)) / F.sqrt(1 / a + 1 / b + 1 / c + 1 / d)
    ranked = counts.withColumn("z", z).filter("z > 5").orderBy(F.desc("z"), F.length("stem"), "stem")
    chosen: list[str] = []
    for r in ranked.limit(50 * setup.induced_voters).collect():
        own = r.stem.rstrip("*")
        if not any(own.startswith(x) or x.startswith(own) for x in (c.rstrip("*") for c in chosen)):
            chosen.append(r.stem)
    return chosen[: setup.induced_voters]


class Voters:
    """All voters, in a fixed order: lexicon and induced stems, densities of stems, patterns."""

    def __init__(self, induced: list[str]):
        self.stems = list(dict.fromkeys([*LEXICON, *induced]))
        self.names = (
            [f"stem:{s}" for s in self.stems] + [f"density:{d}" for d in DENSITIES] + [f"pattern:{p}" for p in PATTERNS]
        )
        self._at = {s: i for i, s in enumerate(self.stems)}
        #: Beginnings that a word must have to be looked up at all.
        self._heads = {s.rstrip("*")[:3] for s in self.stems}

    def vote(self, text: str | None, words: Counter[str] | None = None) -> list[int]:
        """Numbers of the voters that fire on a text, ascending."""
        if not hasattr(self, "_compiled"):
            self._compiled = [(re.compile(p), PATTERN_GATES[name]) for name, p in PATTERNS.items()]
        words = profile(text) if words is None else words
        fired, hits, total = set(), 0, 0
        for w, n in words.items():
            total += n
            if w[:3] in self._heads and (found := [self._at[s] for s in stems(w) if s in self._at]):
                hits += n
                fired.update(found)
        first = len(self.stems)
        fired.update(first + i for i, d in enumerate(DENSITIES) if hits and 1000 * hits >= d * total)
        low = (text or "").lower()
        first += len(DENSITIES)
        for i, (pattern, gate) in enumerate(self._compiled):
            if any(g in low for g in gate) and pattern.search(low):
                fired.add(first + i)
        return sorted(fired)

    def features(self, text: str | None) -> tuple[list[int], np.ndarray]:
        """The votes, and the buckets of the text's words and of the voters that fire."""
        words = profile(text)
        fired = self.vote(text, words)
        idx = {bucket(w) for w in words} | {bucket(f"<{self.names[i]}>") for i in fired}
        return fired, np.sort(np.fromiter(idx, np.int64, len(idx)))

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_compiled"}


@dataclass
class LabelModel:
    """Share of toxic texts, firing rates of the voters by class, and what each one's evidence counts."""

    share: float
    rates: np.ndarray  # (2, voters)
    evidence: np.ndarray  # (voters,)

    def terms(self) -> tuple[float, np.ndarray]:
        """Log-odds of a text on which nothing fires, and what each firing voter adds."""
        silent = np.log((1 - self.rates[1]) / (1 - self.rates[0])) * self.evidence
        firing = np.log(self.rates[1] / self.rates[0]) * self.evidence - silent
        return float(np.log(self.share / (1 - self.share)) + silent.sum()), firing


def fit_label_model(patterns: DataFrame, n_voters: int, share: float, setup: ToxicitySetup) -> tuple[LabelModel, np.ndarray]:
    """The label model of a table of vote patterns (``fired`` array, ``n``), and the correlations.

    Each round is one aggregation of all patterns into one row per voter, so what comes to the
    driver has the size of the voters. Correlations of pairs come from the moments of the votes,
    first over all texts and then within the posterior classes, after which the rates are fitted
    once more.
    """
    rates = np.vstack([np.full(n_voters, 0.002), np.full(n_voters, 0.1)])
    model = LabelModel(min(max(share, 0.001), 0.5), rates, np.ones(n_voters))

    def posterior(m: LabelModel):
        start, terms = m.terms()
        values = F.array(*[F.lit(float(x)) for x in terms])
        odds = F.aggregate("fired", F.lit(start), lambda total, i: total + F.get(values, i))
        return 1 / (1 + F.exp(-odds))

    def sums(m: LabelModel) -> tuple[float, float, np.ndarray]:
        # The number -1 stands for all patterns, whatever fires.
        each = (
            patterns.withColumn("p", posterior(m))
            .select("n", "p", F.explode(F.array_append("fired", -1)).alias("i"))
            .groupBy("i")
            .agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("p")).alias("t"))
            .collect()
        )
        fired, n, t = np.zeros((2, n_voters)), 0.0, 0.0
        for r in each:
            if r.i < 0:
                n, t = float(r.n), float(r.t)
            else:
                fired[:, r.i] = r.n - r.t, r.t
        return n, t, fired

    def rounds(m: LabelModel, times: int) -> tuple[LabelModel, float, float]:
        n = t = 0.0
        for _ in range(times):
            n, t, fired = sums(m)
            if not n:
                return m, 0.0, 0.0
            # Laplace-like smoothing towards voters that are better than chance.
            new = np.vstack([(fired[0] + 0.05) / (n - t + 50), (fired[1] + 0.5) / (t + 10)])
            new = np.clip(new, 1e-6, 0.95)
            m = LabelModel(float(np.clip(t / n, 1e-4, 0.5)), new, m.evidence)
        return m, n, t

    def both_fire(m: LabelModel | None):
        """Weighted counts of pairs of voters that fire together, by class or all as class 0."""
        p = F.lit(0.0) if m is None else posterior(m)
        return (
            patterns.withColumn("p", p)
            .select("n", "p", F.explode("fired").alias("i"), "fired")
            .select("n", "p", "i", F.explode("fired").alias("j"))
            .filter("i < j")
            .groupBy("i", "j")
            .agg(F.sum(F.col("n") * F.col("p")).alias("t"), F.sum(F.col("n") * (1 - F.col("p"))).alias("c"))
            .collect()
        )

    def phi(both: float, total: float, a: float, b: float) -> float:
        spread = np.sqrt(a * (1 - a) * b * (1 - b))
        return float(np.clip((both / total - a * b) / spread, -1, 1)) if total > 0 and spread > 0 else 0.0

    # Voters that nearly always fire together would be taken for the class itself: they share their
    # evidence from the start. No two voters that only share a class are that close.
    correlation = np.eye(n_voters)
    n, _, fired = sums(LabelModel(0.5, np.full((2, n_voters), 0.5), model.evidence))
    often = fired.sum(axis=0) / max(n, 1.0)
    for r in both_fire(None):
        if (value := phi(r.c, n, often[r.i], often[r.j])) > setup.same_voters:
            correlation[r.i, r.j] = correlation[r.j, r.i] = value
    model.evidence = 1 / correlation.sum(axis=0)

    model, n, t = rounds(model, setup.rounds)
    weight = t / n if n else 0.0
    for r in both_fire(model):
        own = [phi(x, k, model.rates[c, r.i], model.rates[c, r.j]) for c, x, k in ((0, r.c, n - t), (1, r.t, t))]
        value = max(own[0] * (1 - weight) + own[1] * weight, correlation[r.i, r.j])
        correlation[r.i, r.j] = correlation[r.j, r.i] = value
    dependent = np.where(correlation > 0.1, correlation, 0).sum(axis=0)
    model = LabelModel(model.share, model.rates, 1 / np.maximum(dependent, 1.0))
    return rounds(model, 3)[0], correlation


@dataclass
class ToxicityModel:
    """Weights and bias of the classifier over words and voters."""

    weights: np.ndarray
    bias: float
    voters: Voters

    def score(self, text: str | None) -> float:
        """Probability of label 1 of the whole text; NULL and empty texts get the bias."""
        if not hasattr(self, "_known"):
            self._known = _WordWeights(self.weights)
        words = profile(text)
        marks = (f"<{self.voters.names[i]}>" for i in self.voters.vote(text, words))
        value = self.bias + sum(map(self._known.__getitem__, words)) + sum(map(self._known.__getitem__, marks))
        return float(1 / (1 + np.exp(-np.clip(value, -30, 30))))

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_known"}


class _WordWeights(dict):
    """Weights by word, remembered up to a bound."""

    def __init__(self, weights: np.ndarray):
        super().__init__()
        self._weights = weights

    def __missing__(self, word: str) -> float:
        if len(self) > 400_000:
            self.clear()
        value = self[word] = float(self._weights[bucket(word)])
        return value


def logistic_regression(rows: list[np.ndarray], target: np.ndarray, setup: ToxicitySetup) -> tuple[np.ndarray, float]:
    """Weights for indicator rows and soft labels, by adaptive proximal gradient descent.

    The penalty on absolute weights leaves none to words that do not tell the classes apart, so
    a long text does not gather the noise of its many words.
    """
    weights = np.zeros(1 << BITS)
    if not rows:
        return weights, float(np.log(0.1 / 0.9))
    used, flat = np.unique(np.concatenate([*rows, np.zeros(0, np.int64)]), return_inverse=True)
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    n, d = len(rows), used.size
    often = (np.bincount(flat, minlength=d) >= 3).astype(float)
    w, c = np.zeros(d), float(np.log(max(target.mean(), 1e-3) / max(1 - target.mean(), 1e-3)))
    squares, squares_c = np.full(d, 1e-8), 1e-8
    for _ in range(setup.descent_rounds):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(owner, w[flat], n) + c, -30, 30)))
        g = np.bincount(flat, (p - target)[owner], d) * often / n
        gc = float((p - target).mean())
        squares += g * g
        squares_c += gc * gc
        rate = 0.5 / np.sqrt(squares)
        w -= rate * g
        w = np.sign(w) * np.maximum(np.abs(w) - rate * setup.lasso, 0.0)
        c -= 0.1 * gc / np.sqrt(squares_c)
    weights[used] = w
    return weights, c


def train(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    parts: int = 4,
    held_out: int = 2,
    setup: ToxicitySetup = ToxicitySetup(),
) -> tuple[ToxicityModel, LabelModel, Voters]:
    """The classifier, the label model and the voters.

    Gold labels, from a bounded sample outside the held-out part, induce lexicon voters and give
    the share of toxic texts; the label model is fitted to the votes on all texts; the classifier
    is fitted to posterior labels of a bounded sample of texts. Without labels the fixed voters
    alone decide; an empty table gives a classifier with a constant score.
    """
    ship_package(docs.sparkSession)
    gold = labelled_sample(docs, labels, key, text, label, parts, held_out, setup.sample_rows)
    gold = materialize(gold, "toxic-sample")
    voters = Voters(induce_lexicon(gold, setup))
    share = gold.agg(F.avg("label")).first()[0]
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(voters)

    @F.pandas_udf("array<int>")
    def vote(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([shared.value.vote(t) for t in batch])

    votes = docs.select(vote(F.col(text)).alias("fired"))
    patterns = materialize(votes.groupBy("fired").agg(F.count("*").alias("n")), "votes")
    model, _ = fit_label_model(patterns, len(voters.names), 0.1 if share is None else float(share), setup)
    start, terms = model.terms()

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for t in batch["text"]:
                fired, idx = shared.value.features(t)
                odds = start + sum(terms[i] for i in fired)
                out.append((float(1 / (1 + np.exp(-np.clip(odds, -30, 30)))), idx.astype("<i4").tobytes()))
            yield pd.DataFrame(out, columns=["p", "words"])

    sample = thinned(docs.select(F.col(text).alias("text")), ["text"], setup.sample_rows)
    found = sample.mapInPandas(encode, "p double, words binary").collect()
    found.sort(key=lambda r: (bytes(r.words), r.p))
    rows = [np.frombuffer(r.words, "<i4").astype(np.int64) for r in found]
    weights, bias = logistic_regression(rows, np.array([r.p for r in found]), setup)
    return ToxicityModel(weights, bias, voters), model, voters


def score_toxicity(docs: DataFrame, model: ToxicityModel, keep: list[str], text: str = "text", name: str = "score") -> DataFrame:
    """``keep`` and the classifier's probability of label 1 for every whole text."""
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def probability(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([shared.value.score(t) for t in batch], dtype="float64")

    return docs.select(*keep, probability(F.col(text)).alias(name))
