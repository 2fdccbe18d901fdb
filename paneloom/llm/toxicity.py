"""Toxicity: a weighted lexicon, matched by Aho-Corasick in folded text and normalised by length."""

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paneloom.llm.tables import save, small_batches, texts_of

# Letters of other scripts and signs that pass for Latin letters (fixed values).
HOMOGLYPHS = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "м": "m", "о": "o", "р": "p", "ѕ": "s",
    "т": "t", "у": "y", "х": "x", "α": "a", "β": "b", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u",
    "χ": "x", "ı": "i", "ł": "l", "ø": "o", "@": "a", "$": "s", "!": "i", "|": "l",
}
# Digits that stand for letters (fixed values).
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g"}
# Harmless phrases that hold a word of the lexicon; their words don't count.
EXCEPTIONS = ("trash can", "trash bag", "trash bin", "clown fish", "idiot proof", "idiot light", "class clown college", "sore loser rule")
LABELLED_ROWS = 16_000  # labelled documents that are used for learning, chosen by a hash of the id
PREFIXES = (4, 5, 6, 7)
LONGEST_WORD = 16
LEAST_TOXIC, LEAST_WEIGHT, MOST_TERMS = 5, 2.5, 4000

_FOLD = str.maketrans(HOMOGLYPHS | DIGITS)
_NOT_LETTERS = re.compile(r"[\W\d_]+")
_MARKS = re.compile("[̀-ͯ­​-‏⁠﻿]+")
# Signs that end a word are punctuation; inside or in front they stand for letters.
_ENDING = re.compile(r"[!|]+(?=\W|$)")


def fold(text: str) -> str:
    """Words in folded lower case, with one space before, between and after them.

    Compatibility forms, accents and invisible characters go, homoglyphs and digits become letters.
    """
    if not text.isascii():
        text = _MARKS.sub("", unicodedata.normalize("NFKD", text))
    text = _ENDING.sub(" ", text).lower().translate(_FOLD)
    return f" {_NOT_LETTERS.sub(' ', text).strip()} "


@dataclass(frozen=True)
class ToxicityModel:
    """Terms (` word ` or ` prefix`) with weights, phrases that don't count, and the score's coefficients."""

    weights: dict[str, float]
    exceptions: tuple[str, ...]
    coefficients: tuple[float, float, float]
    intercept: float

    def matcher(self) -> ahocorasick.Automaton:
        automaton = ahocorasick.Automaton()
        for term, weight in self.weights.items():
            automaton.add_word(term, (len(term), weight))
        for phrase in self.exceptions:
            folded = fold(phrase)
            automaton.add_word(folded, (len(folded), 0.0))
        automaton.make_automaton()
        return automaton


def measures(text: str, matcher: ahocorasick.Automaton) -> tuple[float, float, float]:
    """log(1 + sum of weights), sum of weights per 100 words, log(1 + words).

    A word counts once, with its heaviest term; words in a matched exception phrase don't count.
    """
    folded = fold(text)
    words = folded.count(" ") - 1 if folded.strip() else 0
    best: dict[int, float] = {}
    exempt: list[tuple[int, int]] = []
    if len(matcher):
        for end, (length, weight) in matcher.iter(folded):
            start = end - length + 1
            if weight == 0.0:
                exempt.append((start, end))
            elif weight > best.get(start, 0.0):
                best[start] = weight
    total = sum(w for start, w in best.items() if not any(a <= start < b for a, b in exempt)) if exempt else sum(best.values())
    return math.log1p(total), 100.0 * total / max(words, 1), math.log1p(words)


def _terms(text: str) -> set[str]:
    found: set[str] = set()
    for word in set(fold(text).split()):
        if len(word) <= LONGEST_WORD:
            found.add(f" {word} ")
        found.update(f" {word[:n]}" for n in PREFIXES if len(word) > n)
    return {t for t in found if len(t) > PREFIXES[0]}


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: dict[int, Counter[str]] = {0: Counter(), 1: Counter()}
        for text, toxic in zip(texts_of(batch.column("text")), batch.column("toxic").to_pylist()):
            counts[toxic].update(_terms(text))
        terms = list(counts[0].keys() | counts[1].keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array(terms, pa.string()), *(pa.array([counts[k][t] for t in terms], pa.int64()) for k in (1, 0))],
            names=["term", "toxic", "clean"],
        )


def _measure(model: ToxicityModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = model.matcher()
        for batch in batches:
            rows = np.array([measures(t, matcher) for t in texts_of(batch.column("text"))], dtype=float).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays(
                [batch.column("toxic").cast(pa.float64()), *(pa.array(rows[:, i]) for i in range(3))], names=["label", "m0", "m1", "m2"]
            )

    return run


def held_out(id_column: str = "doc_id"):
    """Whether a row's label is kept from learning: crc32 of the id as text is divisible by 5."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string")) % 5 == 0, F.lit(False))


def train_toxicity(
    docs: DataFrame, labels: DataFrame, most_rows: int = LABELLED_ROWS, exceptions: Sequence[str] = EXCEPTIONS
) -> ToxicityModel:
    """Lexicon weights and score coefficients from labelled documents.

    At most `most_rows` labelled documents are used, the first by a hash of their id, never held-out
    ones. On two thirds of them each word and word beginning gets the logarithm of how much more
    frequent it is in toxic documents; the others fit the score. Only text and label are read.
    Without both labels the lexicon is empty and every score is the share of toxic labels (0 without labels).
    """
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_rows)  # bounded, hence broadcast
    sample = save(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "toxic"))
    first = F.pmod(F.xxhash64(F.lit("lexicon"), "doc_id"), F.lit(3)) != 0
    part = sample.withColumn("first", first)
    totals = {(r["first"], r.toxic): r["n"] for r in part.groupBy("first", "toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clean = totals.get((True, 1), 0), totals.get((True, 0), 0)
    if not all(totals.get((a, b)) for a in (True, False) for b in (0, 1)):
        share = sum(n for (_, t), n in totals.items() if t) / max(1, sum(totals.values()))
        share = min(max(share, 1e-6), 1 - 1e-6) if totals else 0.0
        return ToxicityModel({}, tuple(exceptions), (0.0, 0.0, 0.0), math.log(share / (1 - share)) if share else -math.inf)
    counted = part.where("first").select("text", "toxic").mapInArrow(_count_terms, "term string, toxic long, clean long")
    terms = counted.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    weight = F.log((F.col("toxic") + 0.5) / (toxic + 1)) - F.log((F.col("clean") + 0.5) / (clean + 1))
    best = terms.where(F.col("toxic") >= LEAST_TOXIC).withColumn("weight", F.round(weight, 6)).where(F.col("weight") >= LEAST_WEIGHT)
    lexicon = {r.term: r.weight for r in best.orderBy(F.desc(F.col("weight") * F.log("toxic")), "term").limit(MOST_TERMS).collect()}
    draft = ToxicityModel(lexicon, tuple(exceptions), (0.0, 0.0, 0.0), 0.0)
    measured = part.where("NOT first").select("text", "toxic").mapInArrow(_measure(draft), "label double, m0 double, m1 double, m2 double")
    rows = VectorAssembler(inputCols=["m0", "m1", "m2"], outputCol="features").transform(measured)
    fitted = LogisticRegression(regParam=1e-3, maxIter=50).fit(save(rows.select("label", "features")))
    return ToxicityModel(lexicon, tuple(exceptions), tuple(map(float, fitted.coefficients)), float(fitted.intercept))


def _probability(model: ToxicityModel, found: tuple[float, float, float]) -> float:
    value = model.intercept + sum(c * m for c, m in zip(model.coefficients, found))
    return 1 / (1 + math.exp(-value)) if value > -700 else 0.0


def toxicity_column(model: ToxicityModel):
    """A column function from text to the score between 0 and 1; null texts count as empty."""

    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        matcher = model.matcher()  # one a task
        for part in texts:
            yield pd.Series([_probability(model, measures(t or "", matcher)) for t in part], dtype="float64")

    return F.pandas_udf(score, "double")


def score_toxicity(docs: DataFrame, labels: DataFrame, model: ToxicityModel | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row; 1 is predicted from a score of 0.5.

    Texts are scored whole, in one narrow pass; id, source and language are no inputs. Null texts
    count as empty and get the score of a text without words. Repeated rows come back repeated, an
    empty table gives an empty result, other columns are not read. A null doc_id is not held out.
    """
    small_batches(docs.sparkSession)
    own = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    model = model or train_toxicity(own, labels)
    scored = own.select("doc_id", held_out().alias("held_out"), toxicity_column(model)("text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
