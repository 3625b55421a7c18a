"""Small tables with the awkward cases: nulls everywhere, blanks, long texts, copies, repeated rows, clashing columns."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "s", "ing", "."]) for _ in range(n))


def documents(seed=1, n=40):
    rng = random.Random(seed)
    texts = [prose(rng, rng.randrange(5, 80)) for _ in range(n)]
    texts += [texts[0], texts[1] + " tail", texts[2].upper(), "", "   \n\t ", "one", "Ünïcode ß 日本 𝒳   x\x1cy", "a b c d"]
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)]
    rows += [(len(rows), None, None, None, None), (None, texts[3], None, "s", 1), (None, None, None, None, None)]
    rows += [rows[5], rows[5], (7, "another text under a known id", "en", None, None)]
    rows.append((len(rows), prose(rng, 4000) + " " + "x" * 3000, "en", "s", None))
    return rows


def frame(spark, rows=None):
    return spark.createDataFrame(documents() if rows is None else rows, DOCS)


def clashing(df, names):
    """The frame with extra columns of these names in another case."""
    from pyspark.sql import functions as F

    return df.select("*", *[F.lit("mine").alias(n.upper()) for n in names if n.lower() not in {c.lower() for c in df.columns}])
