"""Language identification with interpolated Kneser-Ney character models, one for each language.

A text is lower-cased and cut at white space; of each word the letters are kept, with marks for its start and
end. A model gives every character the probability after up to four others: the discounted count of the
longest n-gram, plus the mass that the discount freed times the probability from one character less; all orders
but the longest count distinct left neighbours. N-grams and contexts are 64-bit hashes in sorted arrays, which
the languages share, with one column of values per language.

The language of least cross-entropy per character wins. Held-out rows of the sample calibrate how much a
difference in cross-entropy is worth, and from which excess over the usual on a text is none of the languages.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.wordhash import mix, text_chunks, words

UNKNOWN = "und"
ORDER = 5
#: Share of the sample that calibrates instead of counting.
_CALIBRATION = 0.2
#: Calibrating rows below which nothing is calibrated.
LEAST_CALIBRATION = 20
#: Characters that a language could have; the last share of probability is spread over so many.
_ALPHABET = 2000
_START, _END = 1, 2
#: Words whose scores a task remembers.
_KNOWN_WORDS = 400_000
_STEP = np.uint64(0x9E3779B97F4A7C15)


def letters(token: str) -> str:
    """Lower-cased letters of a token."""
    low = token.lower()
    return low if low.isalpha() else "".join(filter(str.isalpha, low))


def _codes(tokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(n x ORDER codes: each character with the ones before it; number of the token) of all characters and ends."""
    padding = [_START] * (ORDER - 1)
    flat: list[int] = []
    size = np.zeros(len(tokens), dtype=np.int64)
    for k, token in enumerate(tokens):
        if token:
            flat += padding
            flat += map(ord, token)
            flat.append(_END)
            size[k] = len(token) + 1
    codes = np.array(flat, dtype=np.uint64)
    token = np.repeat(np.arange(len(tokens)), size)
    some = size[size > 0]
    first = np.cumsum(some + ORDER - 1) - some
    place = np.repeat(first, some) + np.arange(some.sum()) - np.repeat(np.cumsum(some) - some, some)
    return codes[place[:, None] + np.arange(-ORDER + 1, 1)] if len(place) else np.zeros((0, ORDER), np.uint64), token


def _grams(codes: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the last ``order`` characters of each row, and of the context without the very last."""
    context = np.full(len(codes), order, dtype=np.uint64)
    for k in range(ORDER - order, ORDER - 1):
        context = context * _STEP + codes[:, k] + np.uint64(7)
    return mix(context * _STEP + codes[:, -1] + np.uint64(7)), mix(context)


@dataclass
class Model:
    """Sorted hash arrays by order; values have a column for each of ``languages``."""

    languages: list[str]
    grams: list[np.ndarray]
    seen: list[np.ndarray]
    contexts: list[np.ndarray]
    freed: list[np.ndarray]
    #: Worth of a unit of cross-entropy, usual cross-entropy by language, and limits of the excess over it.
    sharpness: float = 4.0
    usual: np.ndarray | None = None
    slack: float = math.inf
    spread: float = 0.0

    def log_probabilities(self, codes: np.ndarray) -> np.ndarray:
        """Natural logarithm of the probability of each row's last character, by language."""
        p = np.full((len(codes), len(self.languages)), 1.0 / _ALPHABET)
        for k in range(ORDER):
            gram, context = _grams(codes, k + 1)
            p *= _look_up(self.contexts[k], self.freed[k], context, 1.0)
            p += _look_up(self.grams[k], self.seen[k], gram, 0.0)
        return np.log(p)


def _look_up(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, otherwise: float) -> np.ndarray:
    if not len(keys):
        return np.full((len(wanted), values.shape[1]), otherwise)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    out = values[at]
    out[keys[at] != wanted] = otherwise
    return out


def _one_language(tokens: list[str], counts: np.ndarray) -> list[tuple]:
    """By order: (n-grams, discounted share, contexts, freed mass), n-grams and contexts sorted."""
    codes, token = _codes(tokens)
    weight = counts[token].astype(np.float64)
    out = []
    for order in range(ORDER, 0, -1):
        gram, context = _grams(codes, order)
        kinds, first, place = np.unique(gram, return_index=True, return_inverse=True)
        count = np.bincount(place, weights=weight, minlength=len(kinds))
        once, twice = (count == 1).sum(), (count == 2).sum()
        discount = once / (once + 2 * twice) if once and twice else 0.5
        contexts, of = np.unique(context[first], return_inverse=True)
        total = np.bincount(of, weights=count, minlength=len(contexts))
        types = np.bincount(of, minlength=len(contexts))
        out.append((kinds, np.maximum(count - discount, 0) / total[of], contexts, discount * types / total))
        # The next order counts distinct longer n-grams, so each kind goes on once.
        codes, weight = codes[first], np.ones(len(first))
    return out[::-1]


def fit_words(by_language: dict[str, tuple[list[str], np.ndarray]]) -> Model:
    """Models from the distinct words, by letters, of each language and how often each occurs."""
    languages = sorted(by_language)
    single = [_one_language(*by_language[x]) for x in languages]
    model = Model(languages, [], [], [], [])
    for k in range(ORDER):
        for which, keys, values, otherwise in (
            (0, model.grams, model.seen, 0.0),
            (2, model.contexts, model.freed, 1.0),
        ):
            every = np.unique(np.concatenate([s[k][which] for s in single] or [np.zeros(0, np.uint64)]))
            table = np.full((len(every), len(languages)), otherwise)
            for column, s in enumerate(single):
                table[np.searchsorted(every, s[k][which]), column] = s[k][which + 1]
            keys.append(every)
            values.append(table)
    return model


class _Scorer:
    """Cross-entropies of texts. The scores of words are remembered, up to a number of them."""

    def __init__(self, model: Model):
        self.model = model
        self.keys = np.zeros(0, np.uint64)
        self.scores = np.zeros((0, len(model.languages) + 1))

    def _of_tokens(self, tokens: list[str]) -> np.ndarray:
        """By token: sum of log probabilities by language, and number of characters and ends."""
        out = np.zeros((len(tokens), len(self.model.languages) + 1))
        low, room = 0, 0
        for k, token in enumerate(tokens):
            room += len(token) + ORDER
            if room > 400_000 or k == len(tokens) - 1:
                codes, at = _codes(tokens[low : k + 1])
                logs = self.model.log_probabilities(codes)
                for column in range(logs.shape[1]):
                    out[low : k + 1, column] = np.bincount(at, weights=logs[:, column], minlength=k + 1 - low)
                out[low : k + 1, -1] = np.bincount(at, minlength=k + 1 - low)
                low, room = k + 1, 0
        return out

    def __call__(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(cross-entropy by language, number of characters and ends) of each row; no letters: 0 of both."""
        found = words(data, bounds)
        kinds, first, place = np.unique(found.hash, return_index=True, return_inverse=True)
        if len(self.keys) > _KNOWN_WORDS:
            self.keys, self.scores = self.keys[:0], self.scores[:0]
        at = np.searchsorted(self.keys, kinds)
        known = np.zeros(len(kinds), dtype=bool)
        if len(self.keys):
            known = self.keys[np.minimum(at, len(self.keys) - 1)] == kinds
        scores = np.empty((len(kinds), self.scores.shape[1]))
        scores[known] = self.scores[at[known]]
        if not known.all():
            raw = data.tobytes()
            spans = zip(found.start[first[~known]].tolist(), found.end[first[~known]].tolist(), strict=True)
            scores[~known] = self._of_tokens([letters(raw[a:b].decode("utf-8", "replace")) for a, b in spans])
            keys = np.concatenate([self.keys, kinds[~known]])
            order = np.argsort(keys, kind="stable")
            self.keys = keys[order]
            self.scores = np.concatenate([self.scores, scores[~known]])[order]
        n = len(bounds) - 1
        sums = np.stack(
            [np.bincount(found.row, weights=scores[place, k], minlength=n) for k in range(scores.shape[1])], axis=1
        )
        size = sums[:, -1]
        return -sums[:, :-1] / np.maximum(size, 1)[:, None], size


def _scored(model: Model):
    """Rows whose last column is the text to rows (other columns, n, entropies)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(model)
        for batch in batches:
            for at, to, data, bounds in text_chunks(batch.column(batch.num_columns - 1)):
                entropy, size = scorer(data, bounds)
                part = batch.slice(at, to - at)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(size), pa.array(list(entropy), pa.list_(pa.float64()))],
                    [*part.schema.names[:-1], "__size", "__entropy"],
                )

    return run


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (language, text) to rows (language, word, count), counted once per batch."""
    for batch in batches:
        counts: dict[tuple[str, str], int] = {}
        for language, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            for token in map(letters, text.split()):
                if token:
                    counts[language, token] = counts.get((language, token), 0) + 1
        if counts:
            names, tokens = zip(*counts, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(names), pa.array(tokens), pa.array(list(counts.values()), pa.int64())],
                ["__lang", "__word", "__count"],
            )


def train(
    labelled: DataFrame,
    rows_per_language: int = 1000,
    most_chars: int = 20_000,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> Model:
    """Models from a bounded sample of the rows that have a text and a language.

    The bound: of each language about ``rows_per_language`` rows, chosen by a hash of id and text; of a text of more
    than ``most_chars`` characters so many in a row, which begin at a place chosen by that hash. The words of the
    sample are counted by Spark; the counts, which the bound holds for as well, come to the driver. A fifth of the
    sample calibrates, but the row of least hash of each language is always counted, so every language that has a
    text with a letter gets a model; other texts are left out. Fewer than ``LEAST_CALIBRATION`` calibrating rows in all: scores keep their default
    sharpness and only texts without a letter are rejected. No labelled rows: a model of no language.
    """
    rows = labelled.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
    rows = rows.select(
        F.col(lang_col).cast("string").alias("__lang"),
        F.col(text_col).cast("string").alias("__text"),
        F.xxhash64(F.col(id_col), F.col(text_col)).alias("__hash"),
    ).where(F.col("__text").rlike(r"\p{L}"))
    unit = F.pmod(F.col("__hash"), F.lit(1_000_000)) / 1_000_000
    found = rows.groupBy("__lang").agg(F.count("*").alias("n"), F.min(unit).alias("least")).collect()
    if not found:
        return fit_words({})
    share = {r["__lang"]: max(rows_per_language / r["n"], 0.0) for r in found}
    share = F.create_map(*[x for lang, part in share.items() for x in (F.lit(lang), F.lit(part))])
    least = F.create_map(*[x for r in found for x in (F.lit(r["__lang"]), F.lit(r["least"]))])
    is_least = unit == F.element_at(least, F.col("__lang"))
    start = F.pmod(F.col("__hash"), F.greatest(F.length("__text") - most_chars, F.lit(0)) + 1) + 1
    sample = rows.where(is_least | (unit < F.element_at(share, F.col("__lang"))))
    sample = sample.withColumn("__text", F.substring("__text", start.cast("int"), F.lit(most_chars)))
    calibrates = ~is_least & (F.pmod(F.xxhash64("__hash"), F.lit(1000)) < 1000 * _CALIBRATION)
    counted = sample.where(~calibrates).select("__lang", "__text")
    counted = counted.mapInArrow(_count_words, "__lang string, __word string, __count long")
    counted = counted.groupBy("__lang", "__word").agg(F.sum("__count").alias("__count")).orderBy("__lang", "__word")
    table = counted.toPandas()
    model = fit_words(
        {lang: (list(t["__word"]), t["__count"].to_numpy()) for lang, t in table.groupby("__lang", sort=True)}
    )
    held = sample.where(calibrates).select("__lang", "__text")
    out = "__lang string, __size double, __entropy array<double>"
    return calibrate(model, held.mapInArrow(_scored(model), out).collect())


def calibrate(model: Model, rows: list) -> Model:
    """Set what turns cross-entropies into scores and rejections from held-out rows (language, size, entropies)."""
    place = {x: k for k, x in enumerate(model.languages)}
    rows = [(place[r[0]], r[1], r[2]) for r in rows if r[0] in place and r[1] > 0]
    if len(rows) < LEAST_CALIBRATION:
        return model
    truth, size, entropy = (np.array(x) for x in zip(*rows, strict=True))
    chances = {}
    for sharpness in 2.0 ** np.arange(-1, 6.5, 0.5):
        p = _shares(entropy, sharpness)[np.arange(len(truth)), truth]
        chances[sharpness] = np.log(np.maximum(p, 1e-12)).mean()
    model.sharpness = float(max(chances, key=chances.get))
    best = entropy.argmin(axis=1)
    least = entropy.min(axis=1)
    middle = np.median(least)
    model.usual = np.array(
        [np.median(least[best == k]) if (best == k).any() else middle for k in range(len(model.languages))]
    )
    excess = least - model.usual[best]
    long = excess[size >= np.median(size)]
    model.slack = 1.5 * max(float(np.quantile(long, 0.999)), 0.25)
    model.spread = 3 * max(float(np.quantile(excess * np.sqrt(size), 0.999)), 1.0)
    return model


def _shares(entropy: np.ndarray, sharpness: float) -> np.ndarray:
    worth = np.exp(-sharpness * (entropy - entropy.min(axis=1, keepdims=True)))
    return worth / worth.sum(axis=1, keepdims=True)


def decide(model: Model, entropy: np.ndarray, size: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(language, score, rejected) of each row."""
    if not model.languages:
        return [UNKNOWN] * len(size), np.zeros(len(size)), np.ones(len(size), dtype=bool)
    best = entropy.argmin(axis=1)
    some = size > 0
    score = np.where(some, _shares(entropy, model.sharpness)[np.arange(len(best)), best], 0.0)
    rejected = ~some
    if model.usual is not None:
        excess = entropy.min(axis=1) - model.usual[best]
        rejected |= excess > model.slack + model.spread / np.sqrt(np.maximum(size, 1))
    return [model.languages[k] if s else UNKNOWN for k, s in zip(best, some, strict=True)], score, rejected


def _predicted(model: Model, with_text: bool):
    """Rows whose last column is the text to rows (other columns, the text if wanted, language, score, rejected)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(model)
        for batch in batches:
            for at, to, data, bounds in text_chunks(batch.column(batch.num_columns - 1)):
                language, score, rejected = decide(model, *scorer(data, bounds))
                part = batch.slice(at, to - at)
                n = part.num_columns - (not with_text)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:n], pa.array(language, pa.string()), pa.array(score), pa.array(rejected)],
                    [*part.schema.names[:n], "lang_pred", "score", "rejected"],
                )

    return run


def identify(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """The columns ``keep`` of each row, with ``lang_pred``, ``score`` (0 to 1) and ``rejected``.

    Only the text decides. Defined cases: a null text and one without a letter are ``und``, rejected, score 0;
    of equal cross-entropies the first language by name wins; a model of no language gives ``und`` for all;
    any other text gets a learned language, and is rejected where its cross-entropy exceeds the calibrated
    limit, which is wider for short texts. Repeated rows get equal results; an empty table gives no rows.
    """
    # The text goes through the batches once, also where it is kept.
    names = {c: "__text" if c == text_col else f"__p{k}" for k, c in enumerate(keep)}
    passed = [c for c in keep if c != text_col]
    rows = docs.select(
        *[F.col(c).alias(names[c]) for c in passed], F.col(text_col).cast("string").alias("__text")
    )
    kinds = "".join(f"{names[c]} {rows.schema[names[c]].dataType.simpleString()}, " for c in passed)
    kinds += "__text string, " * (text_col in keep)
    predicted = _predicted(model, text_col in keep)
    out = rows.mapInArrow(predicted, f"{kinds}lang_pred string, score double, rejected boolean")
    return out.select(*[F.col(names[c]).alias(c) for c in keep], "lang_pred", "score", "rejected")
