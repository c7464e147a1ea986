"""Language identification by words first, then by ever shorter character n-grams.

Model: per language, the log10 relative frequency of its most frequent words and of character
n-grams (words padded with a space on both sides). A word of the text that any language knows is
scored by word frequency; otherwise by the mean over its longest n-grams of which any is known. A
language that lacks a known feature gets a penalty. A text's score for a language is the mean over
its words; the prediction is the best language (of equal ones the first in alphabetical order).

The model is fitted on a bounded sample of the labelled training rows: about
`Fit.docs_per_language` documents of each language (at least one), chosen by a hash of id and text, and
keeps the `Fit.words` most frequent words and `Fit.grams` n-grams per length and language. So it can be
collected and sent to the tasks whatever the size of the corpus; there it is one array per kind of
feature. Prediction covers every whole text in one pass
without a shuffle.

A NULL text or one without a letter gives `und` with score 0, as does a model without languages.
Documents without language take no part in training; rows that repeat id, text and language
count once in it. The score is the share of the best language
when mean scores are read as log10 likelihoods of a word. Repeated rows are each predicted.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mercato.llm.common import batches, ddl, id_remainder, table
from mercato.llm.shingles import text_groups

LETTERS = regex.compile(r"\p{L}+")
UNKNOWN = "und"


@dataclass(frozen=True)
class Fit:
    docs_per_language: int = 4000
    words: int = 20_000
    grams: int = 8_000
    longest: int = 4
    # Added to the log10 frequency of a feature that occurs once, for languages without it.
    penalty: float = -1.0


def words_in(text: str) -> list[str]:
    return LETTERS.findall(text.lower())


def grams_in(word: str, n: int) -> list[str]:
    padded = f" {word} "
    return [padded[i : i + n] for i in range(len(padded) - n + 1)]


class Table(Mapping):
    """Features with their scores by language, as rows of one array."""

    def __init__(self, features: list[str], scores: np.ndarray):
        self.row = {f: i for i, f in enumerate(features)}
        self.scores = scores

    def __getitem__(self, feature: str) -> np.ndarray:
        return self.scores[self.row[feature]]

    def __contains__(self, feature) -> bool:
        return feature in self.row

    def __iter__(self) -> Iterator[str]:
        return iter(self.row)

    def __len__(self) -> int:
        return len(self.row)


@dataclass(frozen=True)
class Model:
    """`tables[0]` holds words, `tables[n]` n-grams; each maps a feature to its scores by language."""

    languages: tuple[str, ...]
    tables: tuple[Mapping[str, np.ndarray], ...]

    def score(self, word: str) -> np.ndarray:
        """Scores of a word that isn't in the word table."""
        for n in range(len(self.tables) - 1, 0, -1):
            known = self.tables[n]
            found = [known[g] for g in grams_in(word, n) if g in known]
            if found:
                return np.mean(found, axis=0)
        return np.zeros(len(self.languages))


class Scores(dict):
    """Word to row of `rows`; a word seen for the first time is scored and kept, up to a limit."""

    def __init__(self, model: Model, limit: int = 200_000):
        super().__init__((w, i) for i, w in enumerate(model.tables[0]))
        self.model = model
        self.fixed = len(self)
        self.rows = np.zeros((self.fixed + limit, len(model.languages)))
        if self.fixed:
            self.rows[: self.fixed] = np.stack(list(model.tables[0].values()))

    def __missing__(self, word: str) -> int:
        i = self[word] = len(self)
        self.rows[i] = self.model.score(word)
        return i

    def mean(self, words: list[str]) -> np.ndarray:
        total = np.zeros(len(self.model.languages))
        room = len(self.rows) - self.fixed
        for start in range(0, len(words), room):  # one round, but for texts of very many words
            part = words[start : start + room]
            if len(self) + len(part) > len(self.rows):  # forget all but the model's words
                kept = list(self.items())[: self.fixed]
                self.clear()
                self.update(kept)
            total += self.rows[list(map(self.__getitem__, part))].sum(axis=0)
        return total / len(words)


def predict_text(text: str | None, scores: Scores) -> tuple[str, float]:
    words = words_in(text) if text else []
    languages = scores.model.languages
    if not words or not languages:
        return UNKNOWN, 0.0
    mean = scores.mean(words)
    best = int(mean.argmax())
    return languages[best], float(1.0 / np.power(10.0, mean - mean[best]).sum())


def _features(fit: Fit):
    """Counts of features per language within each batch: (lang, n, feature, count)."""
    schema = pa.schema([("lang", pa.string()), ("n", pa.int32()), ("feature", pa.string()), ("count", pa.int64())])

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            words: dict[str, Counter] = defaultdict(Counter)
            langs = part.column("lang").to_pylist()
            for group, texts in text_groups(part.column("text")):
                for lang, text in zip(langs[group], texts, strict=True):
                    words[lang].update(words_in(text or ""))

            def rows(words=words):
                for lang, own in words.items():
                    grams: list[Counter] = [Counter() for _ in range(fit.longest + 1)]
                    for word, c in own.items():
                        yield lang, 0, word, c
                        for n in range(1, fit.longest + 1):
                            for g in grams_in(word, n):
                                grams[n][g] += c
                    for n in range(1, fit.longest + 1):
                        for g, c in grams[n].items():
                            yield lang, n, g, c

            yield from batches(schema, rows(), 50_000)

    return count, "lang string, n int, feature string, count bigint"


def sample_share(docs_per_language: int, rows: int) -> float:
    """The share of a language's rows that are wanted."""
    return min(1.0, docs_per_language / max(1, rows))


def sample_of(labelled: DataFrame, fit: Fit) -> DataFrame:
    """About `docs_per_language` rows of each language (all, if fewer), by a hash of id and text.

    A language's row with the smallest hash is always taken, so none is lost whatever its ids and size.
    """
    half = F.lit(2.0**63)
    place = (F.xxhash64(F.lit("language sample"), "doc_id", "text") + half) / (2 * half)  # from 0 to 1
    sizes = labelled.groupBy("lang").agg(F.count("*").alias("n"), F.min(place).alias("least")).collect()
    if not sizes:
        return labelled
    most = F.create_map(
        *(F.lit(x) for r in sizes for x in (r["lang"], max(r["least"], sample_share(fit.docs_per_language, r["n"]))))
    )
    return labelled.filter(place <= F.element_at(most, F.col("lang"))).dropDuplicates(["doc_id", "text", "lang"])


def train(labelled: DataFrame, fit: Fit | None = None) -> Model:
    """A model from `doc_id`, `text` and non-NULL `lang` of `labelled`."""
    fit = fit or Fit()
    count, schema = _features(fit)
    sample = sample_of(labelled.filter(F.col("lang").isNotNull()).select("doc_id", "text", "lang"), fit)
    counts = sample.mapInArrow(count, schema).groupBy("lang", "n", "feature").agg(F.sum("count").alias("count"))
    most = F.when(F.col("n") == 0, fit.words).otherwise(fit.grams)
    ranked = (
        counts.withColumn(
            "_rank",
            F.row_number().over(Window.partitionBy("lang", "n").orderBy(F.desc("count"), "feature")),
        )
        .filter(F.col("_rank") <= max(fit.words, fit.grams))
        .filter(F.col("_rank") <= most)
    )
    rows = ranked.select("lang", "n", "feature", "count").toArrow().to_pylist()
    languages = tuple(sorted({r["lang"] for r in rows}))
    number = {lang: i for i, lang in enumerate(languages)}
    totals: Counter = Counter()
    for r in rows:
        totals[r["lang"], r["n"]] += r["count"]
    tables = []
    for n in range(fit.longest + 1):
        own = sorted((r for r in rows if r["n"] == n), key=lambda r: r["feature"])
        features = sorted({r["feature"] for r in own})
        missing = [math.log10(1 / max(1, totals[lang, n])) + fit.penalty for lang in languages]
        scores = Table(features, np.tile(np.array(missing, dtype=np.float64), (len(features), 1)))
        for r in own:
            scores[r["feature"]][number[r["lang"]]] = math.log10(r["count"] / totals[r["lang"], n])
        tables.append(scores)
    return Model(languages, tuple(tables))


def identify(
    docs: DataFrame, model: Model, text: str = "text", to: tuple[str, str] = ("lang_pred", "score")
) -> DataFrame:
    """`docs` with the predicted language and its score; the other columns pass through as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = ddl(docs, f"{to[0]} string, {to[1]} double")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = Scores(shared.value)
        for part in parts:
            for group, texts in text_groups(part.column(text)):
                found = [predict_text(t, scores) for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [
                        *part.slice(group.start, group.stop - group.start).columns,
                        pa.array([x[0] for x in found], pa.string()),
                        pa.array([x[1] for x in found], pa.float64()),
                    ],
                    names=[*part.schema.names, *to],
                )

    return docs.mapInArrow(run, schema)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = id_remainder("doc_id", 3) == 1
    model = train(docs.select("doc_id", "text", "lang").filter(~held_out))
    found = identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
