"""Toxicity: a counterfactual-regularised classifier.

A logistic regression over the words of a text and their prefixes (inflected
words share a stem): which occur, and which occur twice or more.  Fitting adds a penalty: each labelled text
that names a group is paired with counterfactuals, in which the group's name
is swapped for the other names of its family and for a neutral word, and the
squared change of the score's logit is charged.  Weight then cannot sit on
the name itself, so a neutral mention of a group does not raise the score.

Fitting looks at ``FitRule.max_rows`` labelled rows at most, those of the
smallest hash of their id; that bound is a parameter and everything collected
on the driver is limited by it and ``features``.  Scoring reads every whole
text in tasks, with one table of weights of ``features`` entries.

Defined results: a null text is an empty one and scores as the bias says; a
row whose id is null counts as id '' in the folds; labels that are null or
have no text are not learned from; with labels of one class only (or none)
the score is the smoothed share of label 1 for every text; repeated label
rows count once each; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import prepare_checkpoints, text_of

#: Names of groups by family, in the languages of the corpus; the first word of each is neutral.
IDENTITY_TERMS = (
    ("people", "women", "men", "girls", "boys", "females", "males", "transgender", "nonbinary"),
    ("believers", "christians", "muslims", "jews", "hindus", "buddhists", "sikhs", "atheists", "catholics"),
    ("religious", "christian", "muslim", "jewish", "hindu", "buddhist", "sikh", "atheist", "catholic"),
    ("person", "woman", "man", "girl", "boy", "female", "male"),
    ("citizens", "immigrants", "refugees", "foreigners", "migrants", "natives"),
    ("citizen", "immigrant", "refugee", "foreigner", "migrant", "native"),
    ("local", "black", "white", "asian", "african", "european", "american", "arab", "latino", "mexican", "chinese", "indian"),
    ("adult", "gay", "lesbian", "bisexual", "straight", "queer", "homosexual", "heterosexual"),
    ("resident", "disabled", "blind", "deaf", "autistic", "elderly", "old", "young", "poor", "rich"),
    # German
    ("leute", "frauen", "männer", "mädchen", "jungen"),
    ("gläubige", "christen", "muslime", "juden", "hindus", "buddhisten", "atheisten", "katholiken"),
    ("bürger", "ausländer", "flüchtlinge", "migranten", "einwanderer", "einheimische"),
    ("örtliche", "schwarze", "weiße", "asiatische", "afrikanische", "arabische", "türkische", "polnische"),
    ("erwachsene", "schwule", "lesbische", "homosexuelle", "heterosexuelle", "behinderte", "blinde", "alte", "junge"),
    # French
    ("gens", "femmes", "hommes", "filles", "garçons"),
    ("croyants", "chrétiens", "musulmans", "juifs", "hindous", "bouddhistes", "athées", "catholiques"),
    ("citoyens", "étrangers", "réfugiés", "migrants", "immigrés"),
    ("locaux", "noirs", "blancs", "asiatiques", "africains", "arabes", "européens", "maghrébins"),
    ("adultes", "gays", "lesbiennes", "homosexuels", "hétérosexuels", "handicapés", "aveugles", "vieux", "jeunes"),
    # Spanish
    ("gente", "mujeres", "hombres", "niñas", "niños"),
    ("creyentes", "cristianos", "musulmanes", "judíos", "hindúes", "budistas", "ateos", "católicos"),
    ("ciudadanos", "extranjeros", "refugiados", "migrantes", "inmigrantes"),
    ("locales", "negros", "blancos", "asiáticos", "africanos", "árabes", "europeos", "latinos", "gitanos"),
    ("adultos", "lesbianas", "homosexuales", "heterosexuales", "discapacitados", "ciegos", "viejos", "jóvenes"),
)

#: Scores from here on count as toxic.
THRESHOLD = 0.7

WORD = regex.compile(r"[^\W_]+")


@dataclass(frozen=True)
class FitRule:
    max_rows: int = 12_000
    features: int = 3_000
    min_rows: int = 3  # labelled rows that must hold a feature
    prefixes: tuple[int, ...] = (4, 5, 6)
    ridge: float = 5e-5
    counterfactual: float = 5.0
    steps: int = 400
    rate: float = 0.1


def in_training(doc_id: Column) -> Column:
    """False for the held-out third."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(3)) != 1


def word_features(word: str, prefixes: tuple[int, ...]) -> list[str]:
    return [word, *(word[:k] + "*" for k in prefixes if len(word) > k)]


def word_counts(text: str) -> Counter[str]:
    return Counter(WORD.findall(text.lower()))


def features_of(words: Counter[str], prefixes: tuple[int, ...]) -> set[str]:
    """Words and prefixes that occur, and once more with # those that occur twice or more often."""
    total: dict[str, int] = {}
    for word, count in words.items():
        for f in word_features(word, prefixes):
            total[f] = total.get(f, 0) + count
    return {*total, *(f + "#" for f, count in total.items() if count > 1)}


def counterfactuals(words: Counter[str]) -> list[Counter[str]]:
    """The words of a text with its group names swapped, one for each other name of a family."""
    out = []
    for family in IDENTITY_TERMS:
        named = set(family).intersection(words)
        if named:
            rest = Counter({w: n for w, n in words.items() if w not in named})
            total = sum(words[w] for w in named)
            out += [rest + Counter({other: total}) for other in family if {other} != named]
    return out


@dataclass
class Model:
    bias: float
    weights: dict[str, float] = field(repr=False)
    prefixes: tuple[int, ...] = FitRule.prefixes

    def score_text(self, text: str, known: dict[str, tuple[str, ...]] | None = None) -> float:
        """Probability of label 1.  ``known`` remembers the weighted features of words."""
        known = {} if known is None else known
        weights = self.weights
        total: dict[str, int] = {}
        for word, count in word_counts(text).items():
            own = known.get(word)
            if own is None:
                own = tuple(f for f in word_features(word, self.prefixes) if f in weights or f + "#" in weights)
                if len(known) < 100_000 and len(word) <= 64:
                    known[word] = own
            for f in own:
                total[f] = total.get(f, 0) + count
        held = [weights.get(f, 0.0) for f in total] + [weights.get(f + "#", 0.0) for f, n in total.items() if n > 1]
        z = self.bias + math.fsum(held)
        return 1 / (1 + math.exp(-z)) if z >= 0 else 1 - 1 / (1 + math.exp(z))

    def score(self, text: Column) -> Column:
        known: dict[str, tuple[str, ...]] = {}  # at most 100 000 short words for each task

        def score_all(texts: pa.Array) -> pa.Array:
            return pa.array([self.score_text(t.as_py() or "", known) for t in texts], pa.float64())

        score_all.__annotations__ = {"texts": pa.Array, "return": pa.Array}  # read by arrow_udf
        return F.arrow_udf(score_all, "double")(text)


def sample_rows(docs: DataFrame, labels: DataFrame, rule: FitRule) -> DataFrame:
    """(doc_id, text, y) of the labelled rows to fit on, ``rule.max_rows`` at most."""
    chosen = (
        labels.where(in_training(F.col("doc_id")) & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
        .select(F.col("doc_id").cast("long").alias("doc_id"), (F.col("toxic") > 0).cast("int").alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "y")
        .limit(rule.max_rows)
    )
    # at most max_rows rows of two numbers: small enough to send to every task
    return docs.select("doc_id", text_of().alias("text")).join(F.broadcast(chosen), "doc_id")


def fit(docs: DataFrame, labels: DataFrame, rule: FitRule = FitRule()) -> Model:
    """Learn the model from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic)."""
    prepare_checkpoints(docs.sparkSession)
    rows = sample_rows(docs, labels, rule).checkpoint()  # read three times, max_rows rows
    n = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}  # two rows
    if len(n) < 2:
        share = (n.get(1, 0) + 1) / (sum(n.values()) + 2)
        return Model(math.log(share / (1 - share)), {}, rule.prefixes)
    terms = {w for family in IDENTITY_TERMS for w in family}
    terms |= {t + "#" for t in terms}
    names = sorted(terms.union(select_features(rows, n, rule)))
    weights, bias = fit_weights(training_rows(rows, names, rule), len(names), rule)
    return Model(bias, {f: float(w) for f, w in zip(names, weights, strict=True) if w != 0.0}, rule.prefixes)


def select_features(rows: DataFrame, n: dict[int, int], rule: FitRule) -> list[str]:
    """The features whose share among the two labels differs most, in standard errors."""
    prefixes = rule.prefixes

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, list[int]] = {}
        for batch in batches:
            for text, y in zip(batch["text"], batch["y"].to_pylist(), strict=True):
                for f in features_of(word_counts(text.as_py()), prefixes):
                    totals.setdefault(f, [0, 0])[y] += 1
        yield pa.RecordBatch.from_pydict(
            {
                "feature": pa.array(totals.keys(), pa.string()),
                "in0": pa.array((t[0] for t in totals.values()), pa.int64()),
                "in1": pa.array((t[1] for t in totals.values()), pa.int64()),
            }
        )

    held = rows.select("text", "y").mapInArrow(count, "feature string, in0 long, in1 long")
    in0, in1 = F.sum("in0"), F.sum("in1")
    pooled = (in0 + in1) / (n[0] + n[1])
    spread = F.sqrt(pooled * (1 - pooled) * (1 / n[0] + 1 / n[1]) + 1e-9)
    best = (
        held.groupBy("feature")
        .agg((in0 + in1).alias("rows"), (F.abs(in1 / n[1] - in0 / n[0]) / spread).alias("z"))
        .where((F.col("rows") >= rule.min_rows) & (F.col("z") >= 3))
        .orderBy(F.desc("z"), "feature")
        .limit(rule.features)
    )
    return [r["feature"] for r in best.collect()]


@dataclass
class Training:
    """The sample as flat lists: the features of each row, and the features that each counterfactual adds or takes away."""

    y: np.ndarray
    row: np.ndarray
    col: np.ndarray
    pairs: int
    pair: np.ndarray
    pair_col: np.ndarray
    sign: np.ndarray


def training_rows(rows: DataFrame, names: list[str], rule: FitRule) -> Training:
    """The sample in numbers.  Of a counterfactual only the differences are sent: what both texts hold cancels."""
    prefixes, column = rule.prefixes, {f: k for k, f in enumerate(names)}

    def number(words: Counter[str]) -> set[int]:
        return {column[f] for f in features_of(words, prefixes) if f in column}

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {"x": [], "swaps": [], "swap": [], "feature": [], "sign": []}
            for text in batch["text"]:
                words = word_counts(text.as_py())
                x, swapped = number(words), [number(c) for c in counterfactuals(words)]
                changes = [(n, f, -1) for n, after in enumerate(swapped) for f in sorted(x - after)]
                changes += [(n, f, 1) for n, after in enumerate(swapped) for f in sorted(after - x)]
                out["x"].append(sorted(x))
                out["swaps"].append(len(swapped))
                for k, c in enumerate(("swap", "feature", "sign")):
                    out[c].append([change[k] for change in changes])
            lists = {c: pa.array(v, pa.int32() if c == "swaps" else pa.list_(pa.int32())) for c, v in out.items()}
            yield pa.RecordBatch.from_pydict({"doc_id": batch["doc_id"], "y": batch["y"], **lists})

    coded = rows.mapInArrow(
        encode, "doc_id long, y int, x array<int>, swaps int, swap array<int>, feature array<int>, sign array<int>"
    )
    data = coded.orderBy("doc_id", "y", "x").toArrow().combine_chunks()
    lists = {c: data[c].combine_chunks() for c in ("x", "swap", "feature", "sign")}
    flat = {c: v.flatten().to_numpy(zero_copy_only=False) for c, v in lists.items()}
    length = {c: v.value_lengths().to_numpy(zero_copy_only=False) for c, v in lists.items()}
    swaps = data["swaps"].to_numpy()
    first = np.cumsum(swaps) - swaps  # the number of each row's first counterfactual
    return Training(
        data["y"].to_numpy().astype(float),
        np.repeat(np.arange(len(swaps)), length["x"]),
        flat["x"],
        int(swaps.sum()),
        np.repeat(first, length["swap"]) + flat["swap"],
        flat["feature"],
        flat["sign"].astype(float),
    )


def fit_weights(t: Training, features: int, rule: FitRule) -> tuple[np.ndarray, float]:
    """Minimise class-balanced log-loss + ridge + counterfactual penalty by Adam on the whole sample."""
    y, row, col, pair, pair_col, sign = t.y, t.row, t.col, t.pair, t.pair_col, t.sign
    importance = np.where(y > 0, 0.5 / y.sum(), 0.5 / (1 - y).sum())
    w, bias = np.zeros(features), 0.0
    m, v = np.zeros(features + 1), np.zeros(features + 1)
    for step in range(1, rule.steps + 1):
        z = bias + np.bincount(row, w[col], len(y))
        residual = importance * (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y)
        slope = np.bincount(col, residual[row], features) + rule.ridge * w
        if t.pairs:
            change = np.bincount(pair, sign * w[pair_col], t.pairs)
            slope += rule.counterfactual * 2 / t.pairs * np.bincount(pair_col, sign * change[pair], features)
        g = np.append(slope, residual.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        move = rule.rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
        w, bias = w - move[:-1], bias - move[-1]
    return w, float(bias)


def score_documents(docs: DataFrame, model: Model, threshold: float = THRESHOLD, text: str = "text") -> DataFrame:
    """``docs`` with score and predicted."""
    scored = docs.withColumn("score", model.score(text_of(text)))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
