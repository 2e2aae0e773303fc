"""Fixtures of awkward rows. Workers import the package from this checkout."""

import os
import random
import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parents[2])
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, os.environ.get("PYTHONPATH", "")])

#: Extra columns whose names the operators use themselves.
CLASHING = "h fp rid pos kind held places spans kept left row lines n_lines n_removed component_id _id _rid key weight ids".split()


def prose(seed: int, n: int) -> str:
    """Words of a small vocabulary, a line of about a dozen each."""
    pick = random.Random(seed)
    words = [f"{pick.choice('abcdefgh')}{pick.choice('aeiou')}{pick.randrange(40)}" for _ in range(n)]
    return "\n".join(" ".join(words[i : i + 12]) for i in range(0, n, 12))


@pytest.fixture(scope="session")
def doc_rows():
    """(doc_id, text): copies, near copies, a long shared passage, nulls, empty and very long texts, repeated rows and ids."""
    base = prose(1, 120)
    near = base.replace(base.split()[60], "changed", 1)
    passage = " ".join(prose(2, 60).split())
    rows = [(1, base), (2, base), (3, near), (4, prose(3, 50) + " " + passage + " " + prose(4, 40)), (5, passage + "\n" + prose(5, 80))]
    rows += [(6, None), (7, ""), (8, "   \n\t "), (9, "one two"), (9, "one two"), (10, "x" * 60_000), (11, prose(6, 20_000)), (12, "one two")]
    rows += [(None, base), (None, None), (13, prose(7, 30)), (13, passage), (14, "A b\nA b\nA b\nA b"), (15, base.upper()), (16, "été ▁ \U0001f600 <s> <0x0A>")]
    rows += [(i, prose(i, 40 + i)) for i in range(20, 45)]
    return rows


@pytest.fixture(scope="session")
def docs(spark, doc_rows):
    """The rows as a table with clashing columns, some of them null."""
    from shelfline.llm.common import ship

    ship(spark)
    from pyspark.sql import functions as F

    table = spark.createDataFrame(doc_rows, "doc_id long, text string").repartition(3)
    return table.select("*", F.lit("en").alias("lang"), F.lit(None).cast("string").alias("source"), F.length("text").cast("long").alias("n_chars"), *(F.lit(i).alias(c) for i, c in enumerate(CLASHING)))


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.where("false")
