"""Small tables with every awkward case, and brute-force versions."""

import hashlib
import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, kept boolean, score double, " \
         "row string, n_words long, piece string, spans string, `a.b` string"


def frame(spark, rows):
    """documents with clashing extra columns; rows are (doc_id, text[, lang])."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", None, None, 2.0, "row", -1, "p", None, "dot")
            for r in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


def prose(seed, n, vocabulary=400):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def white_words(text):
    return re.findall("[^\x20\x09-\x0d]+", text or "")


def lower_ascii(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()
