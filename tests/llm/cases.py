"""Fixtures shared by the tests of the training-data operators."""

import random
import zlib

from pyspark.sql import functions as F

DDL = "doc_id long, text string, lang string, source string, n_chars long"
SPACES = " \t\n\x0b\x0c\r"


def folds(parts, remainder):
    return lambda doc_id: doc_id is not None and zlib.crc32(str(doc_id).encode()) % parts == remainder


def words(rng, n, letters="abcdefghé"):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(1, 7))) for _ in range(n))


def awkward_rows(seed=1, n=60):
    """(doc_id, text): ordinary texts, null, empty and blank ones, a very long one, copies, repeated rows, no id."""
    rng = random.Random(seed)
    rows = [(i, words(rng, rng.randint(1, 120)).replace(" a", ".\nA")) for i in range(n)]
    rows += [(n, None), (n + 1, ""), (n + 2, " \t\n"), (n + 3, "x"), (n + 4, "Ünï 日本 \U0001f600 Ää"), (n + 5, words(rng, 40_000))]
    rows += [(n + 6, rows[3][1]), (n + 7, " " + rows[3][1].replace(" ", "\n")), (n + 8, rows[3][1].upper()), (n + 9, "a" * 5000)]
    rows += [(None, rows[4][1]), (None, None), rows[5], rows[5]]
    rng.shuffle(rows)
    return rows


def frame(spark, rows, clash=()):
    """Documents with their usual columns and, for each name in ``clash``, one more of that name."""
    df = spark.createDataFrame([(d, t, None if (d or 0) % 5 == 0 else "en", None if (d or 0) % 7 == 0 else "src", None) for d, t in rows], DDL)
    for name in clash:
        df = df.withColumn(name, F.lit("other"))
    return df


def stored(df, tmp_path, parts=3):
    """``df`` as a table of several files."""
    path = str(tmp_path / "table")
    df.repartition(parts).write.parquet(path)
    return df.sparkSession.read.parquet(path)


def plain(df):
    return sorted([tuple(r) for r in df.collect()], key=repr)
