"""Line de-duplication over levelled sorted runs of line keys.

Every batch of documents is reduced to one row per line key: 128-bit hash, number of documents, largest document id. The batch merge-anti-joins the
runs that exist already, so that only keys which can still change an outcome are added as a run of their own. A run is a table bucketed and sorted
by hash, so merges need no shuffle of what is stored. When a level holds ``fanout`` runs they are merged into one run of the next level.

A line's key is the line without surrounding ASCII white space and with A-Z lower-cased. Keys of at least ``min_chars`` code points that are
found in at least ``min_docs`` rows lose all their lines, except in the rows with the largest id that holds the key.

Defined cases: a null text counts as one empty line; every row is a document, rows that share an id keep or lose a line together; a null id counts as a
document but holds a line only where all holders have null ids; an empty table gives an empty result; other columns pass through untouched, whatever their names.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.sources.session import cut_lineage, scratch_path

WHITE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HASH = ["h1", "h2"]


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    bare = F.btrim(line, F.lit(WHITE))
    plain = F.octet_length(bare) == F.length(bare)
    return F.when(plain, F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


def key_hash(key: Column) -> list[Column]:
    """128 bits in two columns: two keys of a corpus do not meet by chance."""
    return [F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2")]


class LineRuns:
    """The runs of all batches seen so far."""

    def __init__(self, spark: SparkSession, min_docs: int = 3, min_chars: int = 20, fanout: int = 2, buckets: int | None = None):
        self.spark, self.min_docs, self.min_chars, self.fanout = spark, min_docs, min_chars, fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[DataFrame]] = []
        self.tables: list[str] = []

    def batch_keys(self, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
        """One row per key of the batch. Keys are made distinct inside each row, so counting needs no second shuffle."""
        keys = F.array_distinct(F.filter(F.transform(lines_of(F.col(text_col)), line_key), lambda k: F.length(k) >= self.min_chars))
        rows = docs.select(F.col(id_col).alias("id"), F.explode(keys).alias("key")).select("id", *key_hash(F.col("key")))
        return rows.groupBy(*HASH).agg(F.count("*").alias("n_docs"), F.max("id").alias("top_id"))

    def add(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> None:
        fresh = self.batch_keys(docs, id_col, text_col).alias("f")
        for run in (run for level in self.levels for run in level):
            # A run that has already seen enough documents, and none smaller than the batch's, settles the key.
            settled = run.where(F.col("n_docs") >= self.min_docs).alias("r")
            same = (F.col("f.h1") == F.col("r.h1")) & (F.col("f.h2") == F.col("r.h2"))
            older = F.coalesce(F.col("f.top_id") <= F.col("r.top_id"), F.col("f.top_id").isNull())
            fresh = fresh.join(settled, same & older, "left_anti").alias("f")
        self._store(fresh, 0)

    def _store(self, keys: DataFrame, level: int) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        name = f"line_run_{uuid.uuid4().hex}"
        path = scratch_path(self.spark, name)
        keys.write.bucketBy(self.buckets, *HASH).sortBy(*HASH).option("path", path).saveAsTable(name)
        self.tables.append(name)
        self.levels[level].append(self.spark.table(name))
        if len(self.levels[level]) >= self.fanout:
            runs, self.levels[level] = self.levels[level], []
            self._store(merge(runs), level + 1)

    def close(self) -> None:
        """Take the runs out of the catalog; their files go with the scratch folder."""
        while self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.tables.pop()}")

    def repeated(self) -> DataFrame:
        """The keys that lose lines, with the id that keeps them, written once."""
        runs = [run for level in self.levels for run in level]
        return cut_lineage(merge(runs).where(F.col("n_docs") >= self.min_docs).select(*HASH, "top_id"), "repeated-lines")


def merge(runs: list[DataFrame]) -> DataFrame:
    """Sorted merge of runs: counts add up, the largest id wins. Two stored runs meet without a shuffle."""
    merged = runs[0]
    for run in runs[1:]:
        a, b = merged.alias("a"), run.alias("b")
        same = (F.col("a.h1") == F.col("b.h1")) & (F.col("a.h2") == F.col("b.h2"))
        both = a.join(b, same, "full")
        merged = both.select(*[F.coalesce(f"a.{h}", f"b.{h}").alias(h) for h in HASH], (F.coalesce("a.n_docs", F.lit(0)) + F.coalesce("b.n_docs", F.lit(0))).alias("n_docs"), F.greatest("a.top_id", "b.top_id").alias("top_id"))
    return merged


def batches_by_id(docs: DataFrame, n: int, id_col: str = "doc_id") -> Iterable[DataFrame]:
    """The table as ``n`` id ranges, largest ids first: most repeats then meet a run that settles them. Null ids come last."""
    cuts = docs.agg(F.percentile_approx(F.col(id_col), [i / n for i in range(1, n)], 1000).alias("cuts")).first()["cuts"] or []
    cuts, above = sorted(set(cuts), reverse=True), None
    for cut in [*cuts, None]:
        rows = docs
        if above is not None:
            rows = rows.where(F.col(id_col) <= above if cut is not None else (F.col(id_col) <= above) | F.col(id_col).isNull())
        if cut is not None:
            rows = rows.where(F.col(id_col) > cut)
        yield rows
        above = cut


def drop_lines(docs: DataFrame, runs: LineRuns, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with ``row`` (all input columns), ``n_lines``, ``n_dropped`` and ``kept`` (the text that stays).

    Lines meet the repeated keys in one join whose large partitions can be split; positions to drop return to their row by id and text hash.
    """
    tagged = docs.select(F.struct("*").alias("row"), F.struct(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("tag")).alias("at"), lines_of(F.col(text_col)).alias("lines"))
    lines = tagged.select("at", F.posexplode("lines").alias("pos", "line")).select("at", "pos", line_key(F.col("line")).alias("key"))
    lines = lines.where(F.length("key") >= runs.min_chars).select("at", "pos", *key_hash(F.col("key")))
    hits = lines.join(runs.repeated(), HASH).where(~F.col("at.id").eqNullSafe(F.col("top_id")))
    dropped = hits.groupBy("at").agg(F.collect_set("pos").alias("dropped"))
    marked = tagged.join(dropped, "at", "left")
    kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("dropped"))
    text = F.array_join(F.transform(kept, lambda i: F.get("lines", i)), "\n")
    n_dropped = F.coalesce(F.size("dropped"), F.lit(0))
    return marked.select("row", F.size("lines").cast("long").alias("n_lines"), F.when(F.col("dropped").isNull(), F.lit(0)).otherwise(n_dropped).cast("long").alias("n_dropped"),
                         F.when(F.col("dropped").isNull(), F.coalesce(F.col(f"row.`{text_col}`"), F.lit(""))).otherwise(text).alias("kept"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 3, min_chars: int = 20, batches: int = 4, fanout: int = 2) -> DataFrame:
    """Whole-table use: the id ranges of ``docs`` are added batch by batch, then repeated lines are dropped."""
    runs = LineRuns(docs.sparkSession, min_docs, min_chars, fanout)
    for batch in batches_by_id(docs, batches, id_col):
        runs.add(batch, id_col, text_col)
    out = drop_lines(docs, runs, id_col, text_col)
    runs.close()
    return out


def with_kept_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str = "n_chars", **options) -> DataFrame:
    """The rows of ``docs`` with the text that stays, and its length in ``length_col`` where there is such a column."""
    out = dedup_lines(docs, id_col, text_col, **options)
    changed = {text_col: F.col("kept"), length_col: F.length("kept")}
    return out.select(*[changed[c].cast(kind).alias(c) if c in changed else F.col(f"row.`{c}`") for c, kind in docs.dtypes])
