"""A small table with the awkward cases every operator has to take."""

import random

from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"
WORDS = ("amber basil cedar dune ember fjord grove heath inlet jetty knoll lagoon marsh north ocean prairie quarry ridge shore tundra upland valley wharf yonder zephyr").split()

#: Names that operators use inside or give to their results.
CLASHING = ["row", "h1", "key", "lines", "pos", "kept", "shard", "slot", "score", "c", "id", "tag", "seeds", "rank", "ids", "tree", "turn_", "class_id"]


def passage(n, seed):
    """n words that no other seed gives in the same order."""
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + str(seed) for _ in range(n))


def texts():
    long = passage(6000, 3) + "\n" + "a" * 5000 + "\n" * 50
    return [
        (1, passage(60, 1)), (2, passage(60, 1)), (3, passage(60, 1).upper().replace(" ", "  ")), (4, None), (5, ""), (6, " \n\t\n"), (7, long), (8, long + " tail"),
        (None, passage(60, 1)), (None, "nothing in common here"), (9, "short"), (9, "short"), (9, "other text under the same id"), (10, "!!! ??? ..."), (11, "Ünïcödé ÉÀ 日本語 🙂 " * 30),
    ]


def docs(spark, rows=None, clashing=True):
    extra = [T.StructField(n, T.StringType()) for n in CLASHING] if clashing else []
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), *extra])
    return spark.createDataFrame([(i, t, *["x"] * len(extra)) for i, t in (texts() if rows is None else rows)], schema)


def empty(spark):
    return docs(spark, [])
