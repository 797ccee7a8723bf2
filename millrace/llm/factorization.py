"""Toxicity by a factorization machine over hashed terms.

A text's terms are its distinct words and their first four and five letters, hashed to ``2**bits`` columns. The score is the logistic of a linear part
and of the interactions of all pairs of terms, through factors of ``rank`` numbers for each column, so that pairs which matter only together count.
The model is fitted on at most ``most`` labelled rows, those with the smallest hash of their id, in a task; the driver sees the columns that learned, and the model's size is fixed.
Scoring reads every whole text, without a shuffle.

Defined cases: null and empty texts have no terms and get the score of the intercept; rows without a label, or with a null id, are not learned from; of several labels of an id
the largest counts; without labelled rows every score is 0.5, with labels of one kind only the share of toxic rows smoothed by one row of either kind; an empty table gives an empty
result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from millrace.llm.rows import Memo, map_rows, words


@dataclass
class Model:
    bits: int
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def score(self, columns: np.ndarray) -> float:
        own = self.factors[columns]
        total = own.sum(0)
        raw = self.bias + float(self.weights[columns].sum()) + 0.5 * float((total * total - (own * own).sum(0)).sum())
        return float(1 / (1 + np.exp(-min(60.0, max(-60.0, raw)))))


def term_columns(bits: int):
    """A function from text to its sorted distinct columns."""
    mask = 2**bits - 1
    column = lambda term: xxhash.xxh3_64_intdigest(term.encode()) & mask
    of = Memo(lambda w: tuple({column(w), *((column("4" + w[:4]),) if len(w) > 4 else ()), *((column("5" + w[:5]),) if len(w) > 5 else ())}))

    def columns(text: str | None) -> np.ndarray:
        found: set[int] = set()
        found.update(*map(of.__getitem__, set(words(text))))
        return np.array(sorted(found), np.int32)

    return columns


def sample_rows(docs: DataFrame, labels: DataFrame, learn: Column, most: int, bits: int, id_col: str, text_col: str, label_col: str, most_bytes: int = 64 * 2**20) -> DataFrame:
    """(key, label, columns) of at most ``most`` labelled rows, and ``most_bytes`` of column numbers, that ``learn`` allows, in one partition and in order of the id; which rows is decided by the hash of their id."""
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & learn)
    known = known.groupBy(id_col).agg(F.max(F.col(label_col).cast("int")).alias("label"))
    # At most ``most`` pairs of integers: that bounds what is broadcast.
    chosen = known.orderBy(F.xxhash64(id_col), id_col).limit(most)
    rows = docs.select(id_col, text_col).join(F.broadcast(chosen), id_col).select(id_col, "label", text_col)

    def start():
        columns = term_columns(bits)
        return lambda key, label, text: [(key, label, columns(text).tobytes())]

    # One task orders at most ``most`` rows and stops them where there are enough bytes.
    found = map_rows(rows, start, f"key {rows.dtypes[0][1]}, label int, columns binary").orderBy("key", "columns").limit(most)
    upto = F.sum(F.octet_length("columns")).over(Window.orderBy(F.xxhash64("key"), "key", "columns").rowsBetween(Window.unboundedPreceding, 0))
    return found.withColumn("upto", upto).where(F.col("upto") <= most_bytes).drop("upto").coalesce(1).sortWithinPartitions("key", "columns")


def labelled_sample(docs: DataFrame, labels: DataFrame, learn: Column, most: int, bits: int, id_col: str, text_col: str, label_col: str, most_bytes: int = 64 * 2**20) -> list[tuple[int, int, np.ndarray]]:
    """``sample_rows`` as a list."""
    found = sample_rows(docs, labels, learn, most, bits, id_col, text_col, label_col, most_bytes).collect()
    return [(r["key"], r["label"], np.frombuffer(r["columns"], np.int32)) for r in found]


def against_label(rows: np.ndarray, toxic: np.ndarray, n: int, share: float) -> np.ndarray:
    """Chi-square, by one degree, of being present against the label."""
    expected = rows * share
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.nan_to_num((toxic - expected) ** 2 / (expected * (1 - share) * (1 - rows / n)), nan=0.0, posinf=np.inf)


def telling_pairs(sample: list[tuple[int, int, np.ndarray]], own: np.ndarray, columns: np.ndarray, share: float, held: float, least: float = 100.0, more: float = 3.0) -> np.ndarray:
    """Of the given columns, those that with another of them say clearly more of the label than either alone: chi-square of the pair at ``least`` or over, and ``more`` times the larger own one,
    and ``held`` toxic rows or more that hold both: pairs that only a group of copies holds teach nothing.

    A column is a bitmap of the sample's rows; rows that hold a pair are counted in the bitmaps' intersection.
    """
    n, width = len(sample), -(-len(sample) // 64) * 8
    bits = np.zeros((len(columns) + 1, width), np.uint8)  # the last is the label's
    place = np.full(len(own), -1, np.int32)
    place[columns] = np.arange(len(columns))
    for row, (_, label, present) in enumerate(sample):
        mine = place[present]
        bits[mine[mine >= 0], row // 8] |= 1 << row % 8
        bits[-1, row // 8] |= label << row % 8
    words = bits.view(np.uint64)
    found, alone = np.zeros(len(columns), bool), own[columns]
    for start in range(0, len(columns), 128):  # a few columns at a time: small, short-lived arrays
        some = words[start : min(start + 128, len(columns))]
        toxic = some & words[-1]
        for i in range(start + len(some)):
            rows = np.bitwise_count(some & words[i]).sum(axis=1, dtype=np.int64)
            both = np.bitwise_count(toxic & words[i]).sum(axis=1, dtype=np.int64)
            pair = against_label(rows, both, n, share)
            hits = (both >= held) & (pair >= least) & (pair >= more * np.maximum(alone[i], alone[start : start + len(some)]))
            found[i] |= hits.any()
            found[start : start + len(some)] |= hits
    return columns[found]


def fit(sample: list[tuple[int, int, np.ndarray]], bits: int = 18, rank: int = 8, steps: int = 1500, batch: int = 64, rate: float = 0.1, decay: float = 1e-4, least: int = 3, chance: float = 10.8, pair_rows: int = 30, pair_share: float = 0.05, seed: int = 5) -> Model:
    """At least ``steps`` adaptive gradient steps, and five rounds, on the logistic loss.

    Columns learn if they tell something: by themselves (in ``least`` rows or more, with a chi-square against the label of ``chance`` or more), or together with another column, whatever
    each of them tells alone; all others stay zero.
    """
    size = 2**bits
    rng = np.random.default_rng(seed)
    weights, factors, bias = np.zeros(size, np.float32), np.zeros((size, rank), np.float32), 0.0
    y = np.array([label for _, label, _ in sample], np.float32)
    if not len(y) or y.min() == y.max():
        share = (float(y.sum()) + 1) / (len(y) + 2)
        return Model(bits, float(np.log(share / (1 - share))), weights, factors)
    rows = np.zeros(size, np.int64)
    for _, _, columns in sample:
        rows[columns] += 1
    toxic = np.zeros(size, np.int64)
    for _, label, columns in sample:
        toxic[columns] += label
    own = against_label(rows, toxic, len(y), float(y.mean()))
    useful = (rows >= least) & (own >= chance)
    held = max(pair_rows, pair_share * y.sum())
    useful[telling_pairs(sample, own, np.flatnonzero(toxic >= held), float(y.mean()), held)] = True
    factors[useful] = rng.normal(0, 0.01, (int(useful.sum()), rank))
    data = [columns[useful[columns]] for _, _, columns in sample]
    bias = float(np.log(y.mean() / (1 - y.mean())))
    seen_w, seen_v = np.full(size, 1e-2, np.float32), np.full((size, rank), 1e-2, np.float32)
    for _ in range(max(5, -(-steps * batch // len(data)))):
        order = rng.permutation(len(data))
        for at in range(0, len(order), batch):
            some = [data[i] for i in order[at : at + batch]]
            sizes = np.array([len(c) for c in some])
            if not sizes.sum():
                continue
            flat, owner = np.concatenate(some), np.repeat(np.arange(len(some)), sizes)
            v = factors[flat]
            total = np.zeros((len(some), rank), np.float32)
            np.add.at(total, owner, v)
            square = np.bincount(owner, (v * v).sum(1), len(some))
            raw = bias + np.bincount(owner, weights[flat], len(some)) + 0.5 * ((total * total).sum(1) - square)
            error = (1 / (1 + np.exp(-np.clip(raw, -60, 60))) - y[order[at : at + batch]]).astype(np.float32)
            columns, place = np.unique(flat, return_inverse=True)
            g_w = np.bincount(place, error[owner], len(columns)).astype(np.float32) + decay * weights[columns]
            per = error[owner][:, None] * (total[owner] - v)
            g_v = np.stack([np.bincount(place, per[:, f], len(columns)) for f in range(rank)], 1).astype(np.float32) + decay * factors[columns]
            seen_w[columns] += g_w * g_w
            seen_v[columns] += g_v * g_v
            weights[columns] -= rate * g_w / np.sqrt(seen_w[columns])
            factors[columns] -= 0.3 * rate * g_v / np.sqrt(seen_v[columns])
            bias -= rate * float(error.mean())
    return Model(bits, bias, weights, factors)


def fit_in_task(sample: DataFrame, bits: int, **options) -> Model:
    """``fit`` where the sample lies: the driver gets the columns that learned, and not the rows."""
    kind = _parse_datatype_string("bias double, used binary, weights binary, factors binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [(None, label, np.frombuffer(columns.as_buffer(), np.int32)) for batch in batches for label, columns in zip(batch.column(0).to_pylist(), batch.column(1), strict=True)]
        if rows:
            model = fit(rows, bits, **options)
            used = np.flatnonzero((model.weights != 0) | (model.factors != 0).any(1))
            out = [model.bias, *(x.tobytes() for x in (used, model.weights[used], model.factors[used]))]
            yield pa.RecordBatch.from_arrays([pa.array([x], t.type) for x, t in zip(out, to_arrow_schema(kind), strict=True)], schema=to_arrow_schema(kind))

    found = sample.select("label", "columns").mapInArrow(run, kind).collect()
    model = fit([], bits, **options)
    for r in found:
        used = np.frombuffer(r["used"], np.int64)
        model.bias, model.weights[used] = r["bias"], np.frombuffer(r["weights"], np.float32)
        model.factors[used] = np.frombuffer(r["factors"], np.float32).reshape(len(used), model.factors.shape[1])
    return model


def scorer(spark: SparkSession, model: Model) -> Callable[[str], Column]:
    """A column function from whole texts to scores. Only the text travels to Python; the model goes out once, its size is fixed by ``bits`` and ``rank``."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = shared.value
        columns = term_columns(model.bits)
        for texts in batches:
            yield pd.Series([model.score(columns(text)) for text in texts], dtype="float64")

    return score


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and ``score`` of every row."""
    return docs.select(id_col, scorer(docs.sparkSession, model)(text_col).alias("score"))


def learn(docs: DataFrame, labels: DataFrame, allowed: Column, most: int = 20_000, bits: int = 18, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", **options) -> Model:
    return fit_in_task(sample_rows(docs, labels, allowed, most, bits, id_col, text_col, label_col), bits, **options)
