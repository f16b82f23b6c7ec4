"""Language identification with error-correcting output codes over hashed byte n-grams.

Every language has a binary codeword; one logistic classifier per bit separates the languages whose
codeword has a 1 there from the others, on hashed 1- to 4-grams of the lower-cased text. A text is
decoded to the codeword of least weighted logistic loss, each bit weighing in by its accuracy; a text
whose two best codewords lose almost alike is flagged ambiguous.

The fit uses a bounded sample, ``per_language`` rows of each label and ``most_rows`` in all, chosen by a
seeded hash of key and text (documented bounds; whole texts; at least 20 rows of a label). The driver gets
their features, at most 48 KB a row. Predictions read the whole text of every row.

Defined results: ``und`` with score 0 for null texts and texts without a letter, and for every text if
no labelled row exists; one learned language is always predicted with score 1; repeated rows are
predicted alike; null labels are not learned; further columns are ignored.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from locuslens.llm.common import small_batches, with_fields

DIMENSIONS, GRAMS, UNKNOWN = 1 << 13, 4, "und"
MULTIPLIERS = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F)


@dataclass
class Model:
    """Languages in code point order, their codewords (+1/-1), bit classifiers and bit weights."""

    languages: list[str]
    codes: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    trust: np.ndarray


def features(text: str) -> np.ndarray:
    """Unit vector of square-root n-gram counts of the whole text."""
    data = np.frombuffer(b" " + text.lower().encode("utf-8", "replace") + b" ", np.uint8).astype(np.uint64)
    counts = np.zeros(DIMENSIONS)
    gram = np.zeros(len(data), np.uint64)
    for n in range(GRAMS):
        gram = (gram[: len(data) - n] << np.uint64(8)) | data[n:] if n else data
        if not len(gram):
            break
        slots = ((gram + np.uint64(n + 1)) * np.uint64(MULTIPLIERS[n]) & np.uint64(0xFFFFFFFF)) >> np.uint64(19)
        counts += np.bincount(slots.astype(np.int64), minlength=DIMENSIONS)
    counts = np.sqrt(counts)
    return counts / max(np.linalg.norm(counts), 1e-9)


def codewords(count: int, seed: int = 5) -> np.ndarray:
    """One codeword per language: all splits for up to 5 languages, else the best of seeded random codes."""
    if count <= 5:
        bits = max(1, 2 ** (count - 1) - 1)
        code = np.array([[1 if i == 0 else b >> (i - 1) & 1 for b in range(bits)] for i in range(count)])
        return np.where(code == 1, 1.0, -1.0)
    bits, best, spread = 15 + 5 * int(np.ceil(np.log2(count))), None, -1
    r = np.random.default_rng(seed)
    for _ in range(40):
        code = r.choice([-1.0, 1.0], (count, bits))
        code[:, np.abs(code.sum(0)) == count] *= r.choice([-1.0, 1.0], (count, 1))
        apart = ((bits - code @ code.T) / 2 + np.eye(count) * bits).min()
        if apart > spread:
            best, spread = code, apart
    return best


def fit(rows: list[tuple[np.ndarray, np.ndarray, str]], steps: int = 120, rate: float = 8.0, ridge: float = 1e-5) -> Model:
    """Bit classifiers by full-batch gradient descent on ``training_rows``; every language weighs the same."""
    languages = sorted({lang for _, _, lang in rows})
    if not languages:
        return Model([], np.zeros((0, 1)), np.zeros((DIMENSIONS, 1), np.float32), np.zeros(1), np.ones(1))
    codes = codewords(len(languages))
    index = {lang: i for i, lang in enumerate(languages)}
    x = matrix(rows)
    y = np.array([index[lang] for _, _, lang in rows])
    share = (1 / np.bincount(y, minlength=len(languages)))[y][:, None] / len(languages)
    goal = codes[y].astype(np.float32)
    weights, bias = np.zeros((DIMENSIONS, codes.shape[1]), np.float32), np.zeros(codes.shape[1])
    speed, speed_b = np.zeros_like(weights), np.zeros_like(bias)
    for _ in range(steps):
        pull = (share * goal / (1 + np.exp(np.clip(goal * (x @ weights + bias), -30, 30)))).astype(np.float32)
        speed = 0.9 * speed + rate * (x.T @ pull - ridge * weights)
        speed_b = 0.9 * speed_b + 0.1 * rate * pull.sum(0)
        weights, bias = weights + speed, bias + speed_b
    right = (share * ((x @ weights + bias) * goal > 0)).sum(0)
    trust = np.clip(np.log(np.maximum(right, 0.5) / np.maximum(1 - right, 1e-3)), 0.05, None)
    return Model(languages, codes, weights.astype(np.float32), bias, trust / trust.sum())


def matrix(rows: list[tuple[np.ndarray, np.ndarray, str]]) -> np.ndarray:
    """Dense features of ``training_rows``, at most its ``most_rows``."""
    x = np.zeros((len(rows), DIMENSIONS), np.float32)
    for i, (slots, values, _) in enumerate(rows):
        x[i, slots] = values
    return x


def row_of(text: str, lang: str) -> tuple[np.ndarray, np.ndarray, str]:
    """A text as its features that are not 0: slots and values."""
    own = features(text).astype(np.float32)
    slots = np.flatnonzero(own).astype(np.uint16)
    return slots, own[slots], lang


def decode(margins: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best codeword, its share of ``exp(-loss)`` over all codewords, and the loss gap to the second."""
    losses = (np.logaddexp(0, -margins[:, None, :] * model.codes[None]) * model.trust).sum(2) * model.codes.shape[1]
    best = losses.argmin(1)
    ranked = np.sort(losses, 1)
    gap = ranked[:, 1] - ranked[:, 0] if losses.shape[1] > 1 else np.full(len(losses), np.inf)
    score = 1 / np.exp(ranked[:, :1] - losses).sum(1)
    return best, score, gap


def least_loss(margins: np.ndarray, model: Model) -> np.ndarray:
    """Loss of each text to its nearest codeword."""
    return (np.logaddexp(0, -margins[:, None, :] * model.codes[None]) * model.trust).sum(2).min(1) * model.codes.shape[1]


def loss_limit(rows: list[tuple[np.ndarray, np.ndarray, str]], model: Model) -> float:
    """Twice the largest loss of a labelled row, at least a quarter of that of a text that says nothing to any bit."""
    losses = least_loss(matrix(rows) @ model.weights + model.bias, model) if rows and model.languages else []
    return max([0.25 * np.log(2) * model.codes.shape[1], *(2 * x for x in losses)])


def training_rows(docs: DataFrame, usable: Column, key: str = "doc_id", text: str = "text", label: str = "lang", per_language: int = 400, most_rows: int = 4000, seed: int = 7) -> list[tuple[np.ndarray, np.ndarray, str]]:
    """Features of at most ``per_language`` labelled texts of each language that satisfy ``usable``, by seeded hash, and of about ``most_rows`` together.

    Counts per language tell which hashes are small enough: only rows below that bound, some hundred more
    than wanted, are ranked, and the texts of the chosen ones become features where they lie. Rows of one
    key and text count once.
    """
    mark = F.xxhash64(F.col(key).cast("string"), F.xxhash64(text), F.lit(seed))
    labelled = docs.where(usable & F.col(label).isNotNull() & F.col(text).rlike(r"\p{L}")).select(F.col(label).alias("_label"), mark.alias("_mark"), F.col(text).alias("_text"))
    sizes = docs.where(usable & F.col(label).isNotNull()).groupBy(F.col(label).alias("_label")).agg(F.count("*").alias("n")).collect()  # one row per language
    if not sizes:
        return []
    wanted = max(20, min(per_language, most_rows // len(sizes)))
    share = F.create_map(*(F.lit(v) for r in sizes for v in (r["_label"], min(1.0, (2 * wanted + 200) / r["n"]))))
    near = labelled.where(F.col("_mark").cast("double") <= F.element_at(share, F.col("_label")) * 2.0**64 - 2.0**63)
    ranked = near.select("_label", "_mark").distinct().withColumn("_n", F.row_number().over(W.partitionBy("_label").orderBy("_mark")))
    chosen = F.broadcast(ranked.where(F.col("_n") <= wanted).select("_label", "_mark"))  # at most ``wanted`` rows a language
    schema = "label string, mark bigint, slots binary, vals binary"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given: set[tuple[str, int]] = set()
        for batch in small_batches(batches):
            out = []
            for lang, own, value in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (lang, own) not in given:
                    given.add((lang, own))
                    slots, vals, _ = row_of(value, lang)
                    out.append((lang, own, slots.tobytes(), vals.tobytes()))
            columns = zip(*out, strict=True) if out else ([],) * 4
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.binary(), pa.binary()), strict=True)], names=["label", "mark", "slots", "vals"])

    found = near.join(chosen, ["_label", "_mark"], "left_semi").select("_label", "_mark", "_text").mapInArrow(work, schema)
    rows = {(r.label, r.mark): (np.frombuffer(r.slots, np.uint16), np.frombuffer(r.vals, np.float32), r.label) for r in found.dropDuplicates(["label", "mark"]).collect()}
    order = sorted(rows)
    random.Random(seed).shuffle(order)
    return [rows[k] for k in order]


def identify(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", gap: float = 0.15, carry: tuple[str, ...] = (), limit: float | None = None, least_bytes: int = 32) -> DataFrame:
    """``key``, ``carry`` columns, ``lang_pred``, ``score`` and ``ambiguous`` for every row of ``docs``.

    Texts beyond a loss of ``limit`` are ``und``, but for those of fewer than ``least_bytes`` bytes: they hold too few
    n-grams for their loss to tell that they belong to no learned language.
    """
    keep = (key, *carry)
    schema = with_fields(docs.select(*keep).schema, "lang_pred string, score double, ambiguous boolean")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in small_batches(batches):
            texts = batch.column(len(keep)).to_pylist()
            known = [i for i, t in enumerate(texts) if t and own.languages and any(map(str.isalpha, t))]
            names, scores, flags = [UNKNOWN] * len(texts), [0.0] * len(texts), [False] * len(texts)
            if known:
                margins = np.array([features(texts[i]).astype(np.float32) @ own.weights for i in known]) + own.bias
                best, score, apart = decode(margins, own)
                for i, b, s, a in zip(known, best, score, apart, strict=True):
                    names[i], scores[i], flags[i] = own.languages[b], float(min(1.0, s)), bool(a < gap)
                if limit is not None:
                    for i, far in zip(known, least_loss(margins, own) > limit, strict=True):
                        names[i], scores[i] = (UNKNOWN, 0.0) if far and len(texts[i].encode()) >= least_bytes else (names[i], scores[i])
            columns = [pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(flags, pa.bool_())]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *columns], names=[*keep, "lang_pred", "score", "ambiguous"])

    return docs.select(*keep, F.col(text).alias("_text")).mapInArrow(work, schema)


def held_out(key: str = "doc_id") -> Column:
    """One fifth of the rows by the checksum of the key, never learned from."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0


def identify_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang", per_language: int = 400) -> DataFrame:
    """Fit on the rows that are not held out, predict every row: ``key, held_out, lang_pred, score, ambiguous``."""
    model = fit(training_rows(docs, ~held_out(key), key, text, label, per_language))
    found = identify(docs.select(key, text), model, key, text)
    return found.select(key, F.coalesce(held_out(key), F.lit(False)).alias("held_out"), "lang_pred", "score", "ambiguous")
