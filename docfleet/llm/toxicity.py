"""Toxicity scores by gradient-boosted trees over dense features, with isotonic calibration.

1. A sample of at most ``max_train`` labelled rows (a documented bound; the rows with the smallest
   hash of doc_id) is split by another hash into three parts.
2. On the first part a lexicon is learned: words and word beginnings that toxic texts have far more
   often than others, in two grades. It is a table of at most ``LEXICON`` entries.
3. Every whole text becomes a vector of dense features: lexicon densities overall and in the densest
   stretch, closeness of lexicon words to a second-person word, capitals, punctuation, and rates of
   obfuscated words.
4. Boosted trees are fitted on the second part, and an isotonic curve from their scores to
   probabilities on the third.
5. All documents are scored. Labels, language, source and doc_id are no inputs of a score.

Defined results: null and empty texts have zero features and a score like any other text. Where the
labelled sample lacks one of the classes, every score is the rate of the other (0 without labels).
Repeated label rows count once, the larger label wins; null labels or ids are left out. Other columns
pass through and may have any name that does not start with an underscore.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame, functions as F

from docfleet.llm.words import tidy
from docfleet.llm.work import Work

MAX_TRAIN = 9_000
LEXICON = 1_000
STRETCH = 40
NEAR = 5
#: Second-person words (fixed list, English, German, French, Spanish).
SECOND_PERSON = frozenset("you your yours yourself u ur du dich dir dein deine ihr euch tu te toi ton ta tes vous votre vos tú ti tus usted ustedes vosotros".split())
#: Characters that stand for letters in obfuscated words.
STAND_INS = str.maketrans("013457@$!|", "oieastasil")
FEATURES = (
    "log_words", "strong_density", "strong_count", "strong_stretch", "mild_density", "mild_count", "mild_stretch",
    "weight_density", "weight_stretch", "near_second_person", "second_person", "capitals", "capital_words", "exclamations",
    "punctuation", "repeated_marks", "obfuscated", "obfuscated_hits",
)
_EDGES = re.compile(r"^[^\w@$]+|[^\w]+$")
_INNER = re.compile(r"[^\W\d_][\d@$!|*.\-_]+[^\W\d_]")
_REPEATED = re.compile(r"([!?*#$%&.])\1{1,}")
_STARTS = range(3, 9)


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def forms(text: str | None) -> list[tuple[str, bool]]:
    """The words without outer marks, in lower case; obfuscated ones with stand-ins undone and marked."""
    out = []
    for raw in (text or "").split():
        word = _EDGES.sub("", raw)
        if not word:
            continue
        masked = not word.isalpha() and _INNER.search(word) is not None
        word = word.lower()
        out.append((re.sub(r"[\W\d_]", "", word.translate(STAND_INS)) if masked else word, masked))
    return out


def _terms(text: str | None) -> set[str]:
    """Distinct words, and beginnings of words marked with a dash."""
    words = {w for w, _ in forms(text)}
    return words | {f"{w[:n]}-" for w in words for n in _STARTS if len(w) > n}


def learn_lexicon(part: DataFrame) -> dict[str, float]:
    """Terms of ``part`` (text, label) with log odds of at least 1.5; the LEXICON with the most evidence."""

    def count(batches):
        with_, without, docs = Counter(), Counter(), [0, 0]
        for batch in batches:
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
                (with_ if label else without).update(_terms(text))
                docs[bool(label)] += 1
        # a term with no toxic text in this task may have some in another
        terms = list(with_.keys() | without.keys())
        for at in range(0, len(terms), 50_000):
            own = terms[at : at + 50_000]
            yield pa.RecordBatch.from_pydict({"term": own, "n1": [with_[t] for t in own], "n0": [without[t] for t in own]})
        yield pa.RecordBatch.from_pydict({"term": [""], "n1": [docs[1]], "n0": [docs[0]]})

    counts = part.mapInArrow(count, "term string, n1 bigint, n0 bigint").groupBy("term").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))
    counts = counts.persist()
    try:
        docs = counts.filter("term = ''").first()
        if docs is None or not docs["n1"] or not docs["n0"]:
            return {}
        odds = F.log(((F.col("n1") + 0.5) / (docs["n1"] + 1)) / ((F.col("n0") + 0.5) / (docs["n0"] + 1)))
        best = (
            counts.filter("term <> '' AND n1 >= 4").withColumn("odds", odds).filter("odds >= 1.5")
            .orderBy((F.col("odds") * F.sqrt("n1")).desc(), "term").limit(LEXICON).collect()
        )
    finally:
        counts.unpersist()
    return {r["term"]: r["odds"] for r in best}


def features(text: str | None, lexicon: dict[str, float]) -> list[float]:
    text = text or ""
    words = forms(text)
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    weight, second, hidden = np.zeros(n), [], 0
    seen: dict[str, float] = {}
    for i, (w, masked) in enumerate(words):
        value = seen.get(w)
        if value is None:
            value = lexicon.get(w, 0.0)
            for k in _STARTS:
                if len(w) > k:
                    value = max(value, lexicon.get(f"{w[:k]}-", 0.0))
            seen[w] = value
        weight[i] = value
        if w in SECOND_PERSON:
            second.append(i)
        hidden += masked and value > 0
    strong, mild = weight >= 3.0, weight > 0
    stretch = min(STRETCH, n)
    densest = lambda x: float((np.cumsum(np.concatenate([[0.0], x]))[stretch:] - np.cumsum(np.concatenate([[0.0], x]))[:-stretch]).max()) / stretch
    hits = np.flatnonzero(mild)
    near = 0
    if second and len(hits):
        at = np.searchsorted(second, hits)
        place = np.array([-10**9, *second, 10**9])
        near = int((np.minimum(hits - place[at], place[at + 1] - hits) <= NEAR).sum())
    letters = sum(map(str.isalpha, text))
    capitals = sum(map(str.isupper, text))
    raw = text.split()
    return [
        math.log1p(n), float(strong.mean()), math.log1p(strong.sum()), densest(strong), float(mild.mean()), math.log1p(mild.sum()),
        densest(mild), float(weight.mean()), densest(weight), near / n, len(second) / n, capitals / max(1, letters),
        sum(1 for w in raw if len(w) > 2 and w.isupper()) / n, text.count("!") / n,
        sum(map(text.count, ".,;:!?*#$%&|")) / max(1, len(text)), len(_REPEATED.findall(text)) / n,
        sum(m for _, m in words) / n, hidden / n,
    ]


def _with_features(df: DataFrame, lexicon: dict[str, float]) -> DataFrame:
    def rows(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                found = [features(t, lexicon) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found, pa.list_(pa.float64()))], [*part.schema.names, "_x"])

    types = dict(df.dtypes)
    schema = ", ".join([*(f"`{c}` {types[c]}" for c in df.columns), "_x array<double>"])
    return df.mapInArrow(tidy(rows), schema)


class Model:
    """A lexicon, trees and a calibration; or a constant where nothing could be learned."""

    def __init__(self, lexicon: dict[str, float], trees=None, curve=None, rate: float = 0.0):
        self.lexicon, self.trees, self.curve, self.rate = lexicon, trees, curve, rate

    def _raw(self, df: DataFrame) -> DataFrame:
        scored = self.trees.transform(df.withColumn("_features", array_to_vector("_x")))
        return scored.withColumn("_raw", vector_to_array("probability")[1]).drop("rawPrediction", "probability", "prediction", "_features")

    def score(self, docs: DataFrame) -> DataFrame:
        """The rows with score and predicted added."""
        if self.trees is None:
            scored = docs.withColumn("score", F.lit(float(self.rate)))
        else:
            taken = {"score", "predicted", "rawPrediction", "probability", "prediction"}
            plain = docs.select(*[F.col(f"`{c}`").alias(f"_in_{c}" if c in taken else c) for c in docs.columns])
            raw = self._raw(_with_features(plain, self.lexicon))
            curved = self.curve.transform(raw.withColumn("_at", F.col("_raw"))).withColumnRenamed("_fit", "_p")
            # a share of the trees' own score keeps the order within the steps of the curve
            blend = 0.98 * F.col("_p") + 0.02 * F.col("_raw")
            scored = curved.withColumn("score", F.greatest(F.lit(0.0), F.least(F.lit(1.0), blend)))
            scored = scored.select(*[F.col(f"`_in_{c}`" if c in taken else f"`{c}`").alias(c) for c in docs.columns if c != "score"], "score")
        return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def train(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN, work: Work | None = None) -> Model:
    """Learn from labelled rows that are not held out."""
    work = work or Work(docs.sparkSession, "toxicity")
    chosen = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).filter(~held_out(F.col("doc_id")))
        .groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("label"))
        .orderBy(F.xxhash64(F.lit(1), "doc_id"), "doc_id").limit(max_train)
    )
    # at most max_train ids: a proven bound for the broadcast
    sample = work.save(
        docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .join(F.broadcast(work.save(chosen, "chosen")), "doc_id").dropDuplicates(["doc_id"])
        .withColumn("part", F.pmod(F.xxhash64(F.lit(2), "doc_id"), F.lit(20))).drop("doc_id").repartition(8),
        "sample",
    )
    n, positive = sample.agg(F.count(F.lit(1)), F.sum("label")).first()
    rate = float(positive or 0) / n if n else 0.0
    lexicon = learn_lexicon(sample.filter("part < 9").select("text", "label"))
    rows = work.save(_with_features(sample.select("text", "label", "part"), lexicon).drop("text"), "features")
    work.drop("sample")
    fit, rest = rows.filter("part >= 9 AND part < 16"), rows.filter("part >= 16")
    classes = fit.agg(F.min("label"), F.max("label")).first()
    classes2 = rest.agg(F.min("label"), F.max("label")).first()
    if None in (*classes, *classes2) or classes[0] == classes[1] or classes2[0] == classes2[1]:
        return Model({}, rate=rate)
    trees = GBTClassifier(featuresCol="_features", labelCol="label", maxIter=20, maxDepth=3, stepSize=0.3, seed=1, minInstancesPerNode=5).fit(
        fit.select(array_to_vector("_x").alias("_features"), F.col("label").cast("double").alias("label")).coalesce(2)
    )
    model = Model(lexicon, trees, rate=rate)
    points = model._raw(rest).select(F.col("_raw").alias("_at"), F.col("label").cast("double").alias("_y"))
    model.curve = IsotonicRegression(featuresCol="_at", labelCol="_y", predictionCol="_fit").fit(points.withColumn("_at", F.col("_at")).coalesce(1))
    return model


def score_documents(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN, work: Work | None = None) -> DataFrame:
    return train(docs, labels, max_train, work).score(docs)
