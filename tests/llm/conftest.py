import random

import pytest
from pyspark.sql import types as T

WORDS = "the of and a to in is you that it he was for on are as with his they I at be this have from".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "s", "ing", ",", "."]) for _ in range(n))


def corpus():
    """Clean, copied, near-copied, empty, null and very long texts; ties; repeated rows."""
    rng = random.Random(3)
    base = [prose(rng, rng.randint(25, 120)) for _ in range(14)]
    passage = prose(rng, 60)
    rows = [(i, t) for i, t in enumerate(base)]
    rows += [(20, base[0]), (21, base[0].upper()), (22, base[1] + " one more"), (23, base[2].replace(" ", "  \t", 3))]
    rows += [(24 + k, base[3 + k] + "\n" + passage + "\n" + prose(rng, 20)) for k in range(4)]
    near = base[8].split()
    for k in range(6):
        words = list(near)
        words[5 + 7 * k % len(words)] = "changed"
        rows.append((40 + k, " ".join(words)))
    rows += [(60, None), (61, ""), (62, " \n\t "), (63, "word"), (64, "two words"), (None, base[4]), (None, None), (None, base[5] + " x")]
    rows += [(70, passage + " " + passage + " " + passage), (70, passage + " " + passage + " " + passage), (71, base[6]), (71, "another text " + base[6])]
    rows += [(80, prose(rng, 30_000)), (81, "x" * 300_000), (82, "ß É 漢字 " * 40), (83, "pas " * 200)]
    rows += [(90, "All rights reserved. cc by CC-BY! General Public License, cc by"), (91, "Licensed under the Apache License, Version 2.0. " + base[7])]
    return rows


SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # names that the operators use themselves
    T.StructField("quality", T.StringType()), T.StructField("lines", T.LongType()), T.StructField("contamination", T.StringType()),
    T.StructField("holder", T.LongType()), T.StructField("loser", T.LongType()), T.StructField("fp", T.LongType()),
    T.StructField("id", T.LongType()), T.StructField("n_words", T.LongType())])


@pytest.fixture(scope="session")
def edge_rows():
    return corpus()


@pytest.fixture(scope="session")
def edge(spark, edge_rows):
    rows = [(d, t, None if i % 5 == 0 else "en", None if i % 7 == 0 else f"src{i % 3}", None if t is None else len(t),
             "q", 1, None, 2, 3, 4, 5, 6) for i, (d, t) in enumerate(edge_rows)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
